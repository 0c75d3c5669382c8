"""Chunked sequences, the BAM data source, imputation by clusters, cohorts of many samples."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_sources import bam_file

from strandmill.functions import scalars
from strandmill.operators import cohort, markers, nested, runs, sequences
from strandmill.sources import bam, bam_source, readers, writers


def dna(draw, n):
    return "".join(draw.choices("ACGT", k=n))


def turned(text):
    return text.translate(str.maketrans("ACGT", "TGCA"))[::-1]


@pytest.fixture(scope="module")
def genome():
    draw = random.Random(3)
    return {f"chr{k}": dna(draw, n) for k, n in enumerate((1, 59, 60, 61, 997, 12_345))}


def test_slices_of_chunks_equal_slices_of_texts(spark, genome):
    draw = random.Random(5)
    store = sequences.chunked(spark.createDataFrame(list(genome.items()) + [("none", None), ("empty", "")], "chrom string, seq string"), 60)
    assert store.where("chrom in ('none', 'empty')").count() == 0
    assert {r["chrom"]: r["size"] for r in sequences.sizes(store, 60).collect()} == {c: len(s) for c, s in genome.items()}
    asked = [(k, c, a := draw.randrange(0, 1000), a + draw.choice([0, 1, 59, 60, 61, 300, 5000]), draw.random() < 0.5) for k, c in enumerate(draw.choices([*genome, "zz"], k=200))]
    asked += [(900, "chr4", None, 5, False), (901, "chr4", -5, 5, False), (902, "chr4", 10, 5, False), asked[0]]
    rows = spark.createDataFrame(asked, "k long, chrom string, start long, stop long, turned boolean").withColumn("text", F.lit("own"))
    got = sequences.slices(store, rows, ["k"], 60, "turned", "found").collect()
    assert len(got) == len(asked)
    for r in got:
        seq = genome.get(r["chrom"])
        want = None if r["start"] is None else "" if r["stop"] <= max(r["start"], 0) else (seq[max(r["start"], 0) : r["stop"]] or None) if seq else None
        assert r["found"] == (turned(want) if want and r["turned"] else want), r


def test_inverted_chunks_equal_inverted_texts(spark, genome):
    draw = random.Random(8)
    store = sequences.chunked(spark.createDataFrame(list(genome.items()), "chrom string, seq string"), 60)
    places = [("chr5", a := draw.randrange(0, 12_400), a + draw.choice([1, 2, 59, 120, 700, 3000])) for _ in range(25)] + [("chr4", 0, 997), ("chr4", 500, 5000), ("chr3", 10, 10), ("chr0", 0, 1), ("zz", 1, 9)]
    found = sequences.inverted(store, spark.createDataFrame(places, "chrom string, start long, stop long"), 60).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["chrom"], r["chunk"])):
        assert len(got.get(r["chrom"], "")) == 60 * r["chunk"]
        got[r["chrom"]] = got.get(r["chrom"], "") + r["text"]
    for chrom, seq in genome.items():
        for _, a, b in sorted({p for p in places if p[0] == chrom}, key=lambda p: p[1:], reverse=True):
            seq = seq[:a] + turned(seq[a:b]) + seq[b:]
        assert got[chrom] == seq, chrom
    plain = nested.invert_sequences(spark.createDataFrame(list(genome.items()), "chrom string, seq string"), spark.createDataFrame(places, "chrom string, start long, stop long"))
    assert {r["chrom"]: r["seq"] for r in plain.collect()} == got


@pytest.mark.parametrize("packed", [False, True])
def test_fasta_chunks_by_blocks(spark, genome, tmp_path, packed):
    import gzip

    text = "".join(f">{c} some words\n" + "".join(s[k : k + 50] + "\n" for k in range(0, len(s), 50)) for c, s in genome.items()) + ">empty\n\n>chr1 again\nACGT\n"
    path = tmp_path / ("a.fa.gz" if packed else "a.fa")
    path.write_bytes(gzip.compress(text.encode()) if packed else text.encode())
    want = genome | {"chr1": "ACGT"}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
    try:
        store = readers.fasta_chunks(spark, str(path), 60).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert all(r["text"] == want[r["chrom"]][60 * r["chunk"] : 60 * r["chunk"] + 60] for r in store)
    assert len(store) == sum(-(-len(s) // 60) for s in want.values())
    writers.fasta_chunks(spark.createDataFrame(store), str(tmp_path / "out"), parts=3)
    parts = sorted((tmp_path / "out").glob("part-*"))
    flat = "".join(p.read_text() for p in parts)
    assert flat == "".join(f">{c}\n" + "".join(want[c][k : k + 60] + "\n" for k in range(0, len(want[c]), 60)) for c in sorted(want))


def test_templates_and_places(spark, genome):
    table = spark.createDataFrame(list(genome.items()), "chrom string, seq string")
    sites = spark.createDataFrame([("a", "chr5", 700, 705, 60), ("b", "chr5", 600, 605, 60), ("c", "chr5", 12_000, 12_100, 60), ("d", "chr4", 700, 701, 60), ("e", "chr5", 11_700, 11_745, 60)], "id string, chrom string, start long, stop long, sv_size long")
    got = {r["id"]: r for r in markers.templates(sites, table).collect()}
    assert set(got) == {"a", "e"} and got["a"]["seq"] == genome["chr5"][99:1305] and (got["a"]["start"], got["a"]["stop"]) == (700, 705)
    rows = spark.createDataFrame([(k * 7 % 101,) for k in range(101)], "x long").repartition(7)
    assert sorted((r["x"], r["place"]) for r in runs.placed(rows, ["x"]).collect()) == [(k, k + 1) for k in range(101)]
    assert runs.placed(rows.limit(0), ["x"]).collect() == []


@pytest.fixture(scope="module")
def bam_path(tmp_path_factory):
    draw = random.Random(1)
    reads = sorted([(f"r{k}", draw.randrange(3), draw.randrange(60_000), draw.randrange(1, 3000)) for k in range(1500)], key=lambda r: (r[1], r[2])) + [(f"u{k}", -1, -1, 0) for k in range(20)]
    path = tmp_path_factory.mktemp("bam") / "a.bam"
    bam_file(path, reads, ["c1", "c2", "c3"])
    return str(path)


@pytest.mark.parametrize("chunk", [1 << 10, 1 << 14, 1 << 26])
def test_bam_source_equals_the_reader(spark, bam_path, chunk):
    bam_source.register(spark)
    df = spark.read.format("bam").option("chunk", chunk).load(bam_path)
    want = bam.bam(spark, bam_path, chunk=chunk).collect()
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, want), key=repr)
    whole = spark.createDataFrame(want, df.schema)
    for condition in ("rname = 'c2'", "rname = 'c2' and pos >= 20000 and pos < 40000", "pos between 100 and 5000", "rname in ('c1', 'c3') and mapq >= 60 and pos > 59000", "flag = 4", "rname = '*'", "rname = 'zz'", "pos >= 0", "rname = 'c1' and mapq < 10", "length(cigar) > 4 and rname <> 'c1'"):
        got = df.where(condition)
        assert sorted(r["qname"] for r in got.collect()) == sorted(r["qname"] for r in whole.where(condition).collect()), condition
    narrow = spark.read.format("bam").schema("pos long, qname string").option("chunk", chunk).load(bam_path)
    assert sorted(map(tuple, narrow.collect())) == sorted((r["pos"], r["qname"]) for r in want)


def test_bam_source_reads_the_places_asked_for(spark, bam_path):
    reader = bam_source.BamReader({"path": bam_path, "chunk": str(1 << 10)}, spark.read.format("bam").load(bam_path).schema) if bam_source.register(spark) is None else None
    every = len(reader.partitions())
    rest = list(reader.pushFilters([bam_source.EqualTo(("rname",), "c2"), bam_source.GreaterThanOrEqual(("pos",), 20_000), bam_source.LessThan(("pos",), 25_000), bam_source.GreaterThan(("qname",), "r")]))
    assert len(rest) == 1 and 0 < len(reader.partitions()) < every / 4
    # the scan takes both conditions on pushed columns, Spark keeps the other
    plan = spark.read.format("bam").load(bam_path).where("rname = 'c2' and pos < 500 and length(cigar) > 2")._jdf.queryExecution().executedPlan().toString()
    kept = [line for line in plan.splitlines() if "Filter" in line]
    assert any("cigar" in line for line in kept) and not any("rname = c2" in line or "pos < 500" in line or "(pos" in line and "< 500" in line for line in kept), plan


def hierarchical(rows, clusters):
    """Plain average-linkage clustering."""
    groups = [[k] for k in range(len(rows))]
    while len(groups) > max(1, clusters):
        best = min((sum(sum(x != y for x, y in zip(rows[p], rows[q])) for p in a for q in b) / (len(a) * len(b)), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        _, i, j = best
        groups[i] += groups.pop(j)
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("seed", range(12))
def test_clusters_equal_plain_average_linkage(seed):
    draw = np.random.default_rng(seed)
    rows = np.unique(draw.integers(0, 2, (int(draw.integers(1, 14)), 6)).astype(float), axis=0)
    for clusters in (1, 2, 3, 5, len(rows)):
        owner = cohort.clustered(rows, clusters)
        assert {frozenset(np.flatnonzero(owner == k).tolist()) for k in set(owner.tolist())} == hierarchical(rows.tolist(), clusters)


def test_imputation_by_clusters_equals_plain_python(spark):
    draw = random.Random(6)
    samples, variants, k, count = [f"s{x}" for x in range(9)], 40, 2, 3
    calls = {(v, s): draw.choice(["0/0", "0/0", "1/1", "0/1", "./."]) for v in range(variants) for s in samples}
    del calls[3, "s1"]
    rows = spark.createDataFrame([(f"v{v}", v * 10, s, g, f"c{v // 25}") for (v, s), g in calls.items()], "id string, pos long, sample string, gt string, chrom string")
    got = {(r["id"], r["sample"]): r["imputed"] for block in (4, 1024) for r in cohort.impute_clusters(rows, ["id"], ["pos"], count, k, ("chrom",), 0.6, block=block).collect()}
    bits = {"0/0": [1, 0, 0], "1/1": [0, 1, 0], "0/1": [0, 0, 1], "./.": [0, 0, 0]}
    for v in range(variants):
        own = [s for s in samples if (v, s) in calls]
        want = {s: calls[v, s] for s in own}
        missing = [s for s in own if calls[v, s] == "./."]
        if missing and len(missing) / (len(own) + 5) <= 0.6:
            names = {s: [calls.get((u, s), "./.") if 0 <= u < variants and u // 25 == v // 25 else "./." for u in range(v - k, v + k + 1)] for s in own}
            distinct = sorted(set(map(tuple, names.values())), key=",".join)
            for group in hierarchical([sum((bits[c] for c in p), []) for p in distinct], count):
                inside = [s for s in own if distinct.index(tuple(names[s])) in group]
                known = [s for s in inside if calls[v, s] != "./."]
                for s in inside:
                    if calls[v, s] == "./." and known:
                        want[s] = calls[v, known[0]]
        assert {s: got[f"v{v}", s] for s in own} == want, v


def test_cohort_of_twenty_thousand_samples(spark):
    names = spark.createDataFrame([(f"s{k:05d}", k + 1) for k in range(20_000)], "sample string, place int")
    long = spark.createDataFrame([("a", "c", 5, "s00000", "1/1"), ("a", "c", 5, "s19999", "0/1"), ("b", "c", 9, "s00007", "0/0"), ("b", "c", 9, "s00007", "1/1"), ("b", "c", 9, "zz", "1/1")], "id string, chrom string, pos long, sample string, gt string")
    found = cohort.cohort_arrays(long, names)
    assert len(found.columns) == 4
    got = {r["id"]: r["calls"] for r in found.collect()}
    assert all(len(c) == 20_000 for c in got.values())
    assert [k for k, c in enumerate(got["a"]) if c != "./."] == [0, 19_999] and got["b"][7] == "1/1" and got["b"].count("./.") == 19_999
    few = {r["id"]: [tuple(x) for x in r["calls"]] for r in cohort.cohort_arrays(long, names, usual="0/0", sparse=True).collect()}
    assert few == {"a": [(1, "1/1"), (20_000, "0/1")], "b": [(8, "1/1")]}
    assert cohort.cohort_arrays(long.limit(0), names).collect() == []


def test_files_to_samples_and_made_up_calls(spark, tmp_path):
    (tmp_path / "x1.signal").write_text("c\t5\n")
    (tmp_path / "y.z.signal").write_text("c\t6\nd\t7\n")
    table = readers.with_sample(readers.tsv(spark, str(tmp_path / "*.signal"), "chrom string, pos long"), r"\.signal")
    assert sorted((r["sample"], r["pos"]) for r in table.collect()) == [("x1", 5), ("y.z", 6), ("y.z", 7)]
    calls = writers.demo_genotypes(spark.createDataFrame([("chr1",), ("12",), ("chr13",), ("chrX",)], "chrom string")).collect()
    assert {r["chrom"]: r["gt"] for r in calls} == {"chr1": "1/1", "12": "1/1", "chr13": "0/1", "chrX": "0/1"}
    assert spark.range(1).select(scalars.tolerance(F.lit(300), "fixed_ins")).head()[0] == 200.0


def test_streamed_cohort_merge_equals_the_merge_of_all_files(spark, tmp_path):
    from strandmill.operators import clusters, windows
    from strandmill.streaming import cohort as streamed

    draw = random.Random(12)
    schema = "chrom string, sv_type string, start long, stop long, sv_len long, maq int, sample string, seen timestamp_ntz"
    rows = []
    for k in range(600):
        at, size = draw.choice([1000, 1024, 2040, 5000, 5060, 9000]) + draw.randrange(0, 160), draw.choice([40, 44, 50, 300])
        rows.append((draw.choice("cd"), draw.choice(["DEL", "INS"]), at, at + size, size, draw.randrange(20, 60), f"s{k % 4}", None))
    rows += [("c", "DEL", 1024 * k + d, 1024 * k + d + 50, 50, 30, "s0", None) for k in range(3) for d in range(0, 1024, 90)]
    table = spark.createDataFrame(rows, schema).withColumn("seen", F.timestamp_seconds(F.lit(1_700_000_000) + F.substring("sample", 2, 1).cast("int") * 60))
    for s in range(4):
        table.where(F.col("sample") == f"s{s}").coalesce(1).write.parquet(str(tmp_path / f"in/s{s}"))
    # what comes two days later closes the window
    table.limit(1).withColumn("seen", F.col("seen") + F.expr("interval 2 days")).coalesce(1).write.parquet(str(tmp_path / "in/z"))
    columns = "chrom string, sv_type string, start long, stop long, sv_len long, maq int, sample string, seen timestamp"
    stream = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    query = streamed.merge_into(stream, str(tmp_path / "out"), str(tmp_path / "check"), stretch=10)
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("chrom", "sv_type", "start", "stop", "sv_len", "maq", "merged").collect()
    want = clusters.cohort_merge(windows.adjacent(table, ["chrom", "sv_type"], ["stop", "sv_len", "maq"], 100), ["chrom", "sv_type"], ["start", "stop", "sv_len"]).drop("island").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 10
