"""Readers and writers on small files."""

import gzip
import random
import struct
import zlib

from pyspark.sql import functions as F

from strandmill.operators import filters
from strandmill.sources import readers, writers
from strandmill.streaming import ingest

SAM = "@HD\tVN:1.6\nq1\t0\tc\t101\t60\t5S60D10M\t*\t0\t0\tACGTACGTACGTACG\t*\tNM:i:1\tSA:Z:c,500,-,5M,60,0;\nq2\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*\nq3\t0\tc\t11\t60\t2000000M\t*\t0\t0\t*\t*\n"


def test_sam(spark, tmp_path):
    (tmp_path / "a.sam").write_text(SAM)
    got = {r["qname"]: r for r in readers.sam(spark, str(tmp_path / "a.sam")).collect()}
    assert set(got) == {"q1", "q2"}
    assert (got["q1"]["pos"], got["q1"]["sa"], got["q2"]["sa"]) == (100, "c,500,-,5M,60,0;", None)


def block(data):
    packer = zlib.compressobj(wbits=-15)
    body = packer.compress(data) + packer.flush()
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


def test_bam(spark, tmp_path):
    tags = b"NMC\x01SAZc,500,-,5M,60,0;\0"
    record = struct.pack("<iiBBHHHiiii", 0, 100, 3, 60, 0, 2, 16, 4, -1, -1, 0) + b"q1\0" + struct.pack("<II", 5 << 4 | 4, 4 << 4) + bytes([0x12, 0x48]) + b"\xff" * 4 + tags
    raw = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 2) + b"c\0" + struct.pack("<i", 1000) + struct.pack("<i", len(record)) + record
    (tmp_path / "a.bam").write_bytes(block(raw[:20]) + block(raw[20:]) + block(b""))
    assert [tuple(r) for r in readers.bam(spark, str(tmp_path / "a.bam")).collect()] == [("q1", 16, "c", 100, 60, "5S4M", "ACGT", "c,500,-,5M,60,0;")]


def bam_file(path, reads, names, piece=300):
    """A sorted BAM file of small blocks, so that records reach over them, and its index. reads: (name, ref, pos, cigar)."""
    raw = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", len(names)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", 1 << 20) for n in names)
    places = []
    for name, ref, pos, n in reads:
        record = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 60, 0, 1 if n else 0, 0 if n else 4, 0, -1, -1, 0) + name.encode() + b"\0" + (struct.pack("<I", n << 4) if n else b"") + b"XYZ" + name.encode() * 20 + b"\0"
        places.append(len(raw))
        raw += struct.pack("<i", len(record)) + record
    out, blocks = b"", []
    for k in range(0, len(raw), piece):
        blocks.append(len(out))
        out += block(raw[k : k + piece])
    virtual = lambda at: blocks[at // piece] << 16 | at % piece if at < len(raw) else len(out) << 16
    index = b"BAI\1" + struct.pack("<i", len(names))
    for ref in range(len(names)):
        own = [(virtual(at), virtual(places[k + 1] if k + 1 < len(places) else len(raw)), r[2], r[2] + max(r[3], 1)) for k, (at, r) in enumerate(zip(places, reads)) if r[1] == ref]
        linear = [min((a for a, _, x, y in own if x >> 14 <= w <= y - 1 >> 14), default=0) for w in range(max((y - 1 >> 14 for *_, y in own), default=-1) + 1)]
        index += struct.pack("<i", 2) + struct.pack("<IiQQ", 4681, 1, own[0][0], own[-1][1]) + struct.pack("<IiQQQQ", 37450, 2, 0, 1 << 60, 5, 5) if own else struct.pack("<i", 0)
        index += struct.pack("<i", len(linear)) + struct.pack(f"<{len(linear)}Q", *linear)
    path.write_bytes(out + block(b""))
    path.with_suffix(".bam.bai").write_bytes(index)


def test_bam_by_ranges_and_regions(spark, tmp_path):
    draw = random.Random(4)
    names = ["c1", "c2", "empty"]
    reads = sorted((ref, draw.randrange(200_000), draw.choice([100, 900, 40_000])) for ref in (0, 1) for _ in range(300))
    reads = [(f"r{k}", ref, pos, n) for k, (ref, pos, n) in enumerate(reads)] + [("u", -1, -1, 0)]
    bam_file(tmp_path / "a.bam", reads, names)
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.bam").write_bytes((tmp_path / "a.bam").read_bytes())
    every = sorted(r[0] for r in reads)
    for regions in (None, [("c1", 50_000, 50_001)], [("c1", 70_000, 90_000), ("c1", 80_000, 120_000), ("c2", 0, 10), ("c1", 125_000, 125_500), ("none", 0, 9)], [("empty", 0, 100)]):
        want = every if regions is None else sorted(n for n, ref, pos, size in reads if ref >= 0 and any(names[ref] == c and pos < b and pos + size > a for c, a, b in regions))
        for folder, chunk in ((tmp_path / "a.bam", 2_000), (tmp_path / "a.bam", 1 << 26), (tmp_path / "plain", 2_000)):
            assert sorted(r["qname"] for r in readers.bam(spark, str(folder), regions, chunk).collect()) == want
    assert readers.bam(spark, str(tmp_path / "a.bam"), None, 2_000).rdd.getNumPartitions() > 4


def test_fasta_plain_and_gzip(spark, tmp_path):
    text = ">c1 first\nACGT\nAC\n>c2\nGG\n\n"
    (tmp_path / "a.fa").write_text(text)
    (tmp_path / "b.fa.gz").write_bytes(gzip.compress(text.encode()))
    for name in ("a.fa", "b.fa.gz"):
        assert {r["chrom"]: r["seq"] for r in readers.fasta(spark, str(tmp_path / name)).collect()} == {"c1": "ACGTAC", "c2": "GG"}


def test_vcf_round_trip(spark, tmp_path):
    calls = spark.createDataFrame([("chr2", 5, 104, "DEL", 100, "0/1"), ("chr10", 7, 8, "INS", -50, "1/1")], "chrom string, start long, stop long, sv_type string, target_size long, gt string")
    contigs = spark.createDataFrame([("chr2", 1000), ("chr10", 900)], "chrom string, size long")
    writers.vcf(writers.vcf_rows(calls, "s1"), contigs, ["s1"], str(tmp_path / "v"), 1)
    back = readers.sv_intervals(readers.vcf(spark, str(tmp_path / "v")))
    got = {r["id"]: (r["start"], r["stop"], r["sv_type"], r["sv_len"], r["sample"], r["gt"]) for r in back.collect()}
    assert got == {"chr2:5-104_100": (5, 104, "DEL", 100, "s1", "0/1"), "chr10:7-8_50": (7, 8, "INS", 50, "s1", "1/1")}
    lines = [r[0] for r in spark.read.text(str(tmp_path / "v")).collect()]
    assert sum(x.startswith("##contig") for x in lines) == 2 and sum(x.startswith("#CHROM") for x in lines) == 1


def test_vcf_tells_support(spark):
    calls = spark.createDataFrame([("c", 5, 9, "DEL", 40, "0/1", "total_map_reads_l=3;total_map_reads_r=4", "l_ratio=0.5,r_ratio=0.4;DEL", 33, None), ("c", 5, 7, "TRA", 0, "1/1", "total_map_reads=1", "INS_rate=1;TRA", 60, "d")], "chrom string, start long, stop long, sv_type string, target_size long, gt string, maps string, rates string, maq int, chrom2 string")
    info = {r["alt"]: r["info"] for r in writers.vcf_rows(calls, "s1").collect()}
    assert info["<DEL>"] == "END=9;CHR=c;SV_START=5;SVLEN=40;method=strandmill;total_map_reads_l=3;total_map_reads_r=4;maq=33;l_ratio=0.5,r_ratio=0.4;SVTYPE=DEL"
    assert "END=d:7;" in info["<TRA>"]


def test_cohort_rows(spark):
    rows = spark.createDataFrame([("c", 5, "a", "<DEL>", "s1", "0/1"), ("c", 5, "a", "<DEL>", "s2", "1/1"), ("c", 8, "b", "<INV>", "s2", "0/0")], "chrom string, pos long, id string, alt string, sample string, gt string")
    rows = rows.selectExpr("chrom", "pos", "id", "'N' as ref", "alt", "'.' as qual", "'PASS' as filter", "'x' as info", "'GT' as format", "sample", "gt")
    found = {r["id"]: (r["info"], r["s1"], r["s2"]) for r in writers.cohort_rows(rows, ["s1", "s2"]).collect()}
    assert found == {"a": (".", "0/1", "1/1"), "b": (".", "./.", "0/0")}
    assert [r["id"] for r in writers.cohort_rows(rows, ["s1"], indels=True).collect()] == ["a"]


def test_tables_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("Chr10", 5, 9, "DEL", "s1"), ("Chr2", 5, 9, "DEL", "s1"), ("Chr2", 1, 9, "INS", "s2"), ("Chr2", 1, 9, "INS", "s2")], "chrom string, start long, stop long, sv_type string, sample string")
    writers.genotype_table(rows, str(tmp_path / "g"))
    back = [r["value"].split("\t")[:2] for r in spark.read.text(str(tmp_path / "g")).collect() if not r["value"].startswith("chrom")]
    assert sorted(back) == [["Chr10", "5"], ["Chr2", "1"], ["Chr2", "5"]]
    writers.by_parts(rows, str(tmp_path / "p"), "sample", "sv_type")
    assert spark.read.parquet(str(tmp_path / "p")).where("sample = 's2'").count() == 2
    writers.fasta(spark.createDataFrame([("c1", "ACGT" * 40)], "chrom string, seq string"), str(tmp_path / "f"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "f")).collect()]
    assert lines[0] == ">c1" and "".join(lines[1:]) == "ACGT" * 40 and max(map(len, lines)) == 60


def test_pileup_fai_and_pairs(spark, tmp_path):
    (tmp_path / "p.txt").write_text("c\t7\tA\t3\t.,T\tIII\t1\tt\tI\n")
    row = readers.pileup(spark, str(tmp_path / "p.txt")).head()
    assert (row["chrom"], row["pos"], row["ref"], row["columns"]) == ("c", 7, "A", ["3", ".,T", "III", "1", "t", "I"])
    (tmp_path / "x.fai").write_text("c1\t100\t4\t60\t61\nc2\t50\t120\t60\t61\n")
    assert [(r["chrom"], r["size"], r["rank"]) for r in readers.fai(spark, str(tmp_path / "x.fai")).orderBy("rank").collect()] == [("c1", 100, 1), ("c2", 50, 2)]
    (tmp_path / "q").mkdir()
    for name in ("a_1.fastq.gz", "a_2.fastq.gz", "b_R1.fastq.gz"):
        (tmp_path / "q" / name).write_bytes(b"x")
    found = {r["sample"]: (r["first"] is not None, r["second"] is not None) for r in readers.paired_reads(spark, str(tmp_path / "q")).collect()}
    assert found == {"a": (True, True), "b": (True, False)}


def test_long_operations(spark):
    reads = spark.createDataFrame([("a", "10M5S"), ("b", "200M"), ("c", "10M200H")], "qname string, cigar string")
    assert [r["qname"] for r in filters.long_operations(reads, 100).collect()] == ["a"]
    assert sorted(r["qname"] for r in filters.long_operations(reads, 100, True).collect()) == ["a", "b"]


def test_vcf_translocation_end(spark, tmp_path):
    (tmp_path / "t.vcf").write_text("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\nc\t5\ti\tN\t<TRA>\t.\t.\tSVTYPE=TRA;END=d:77;SVLEN=0\tGT:DP\t0/1:3\t./.:0\n")
    rows = readers.sv_intervals(readers.vcf(spark, str(tmp_path / "t.vcf"))).orderBy("sample").collect()
    assert [(r["start"], r["stop"], r["sample"], r["gt"]) for r in rows] == [(5, 77, "s1", "0/1"), (5, 77, "s2", "./.")]


def test_user_variants(spark, tmp_path):
    (tmp_path / "u.txt").write_text("c1 100 50 DEL\nc1 9 20 ins\nshort line\nc1 5 c2 70\n")
    got = sorted((r["sv_type"], r["start"], r["stop"], r["chrom2"], r["start2"], r["svid"]) for r in readers.user_variants(spark, str(tmp_path / "u.txt")).collect())
    assert got == [("DEL", 100, 150, None, None, "c1:100-150_DEL=50"), ("INS", 9, 10, None, None, "c1:9-10_INS=20"), ("TRA", 5, 5, "c2", 70, "c2:70_c1:5")]


def test_enzymes_with_a_fourth_field_and_missing_table(spark, tmp_path):
    (tmp_path / "e").write_text("AluI AGCT AG^CT\nX GATC ^GATC extra\nbad\n")
    assert readers.enzymes(spark, str(tmp_path / "e")).count() == 2
    assert readers.tsv(spark, str(tmp_path / "none"), "a string", missing="empty").count() == 0


def test_gff(spark, tmp_path):
    (tmp_path / "g.gff3").write_text("##gff\nc\t.\tmRNA\t1\t100\t.\t+\t.\tID=g1;Name=x\nc\t.\tCDS\t10\t20\t.\t+\t0\tID=cds;Parent=g1\nc\t.\tCDS\t30\t30\t.\t+\t0\tParent=g1\n")
    genes, cds = readers.gff(spark, str(tmp_path / "g.gff3"))
    assert [tuple(r) for r in genes.collect()] == [("g1", "c", 1, 100, "+")] and [tuple(r) for r in cds.collect()] == [("g1", 10, 20)]


def test_stream_takes_each_file_once(spark, tmp_path):
    source, table, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    rows = spark.createDataFrame([("c", 1, 100, size, f"i{size}", "DEL", "*", 60, 3, 0.5, "s1") for size in (10, 100)], "chrom string, start long, stop long, sv_len long, svid string, sv_type string, seq string, maq int, cluster_size long, sv_rate double, sample string").withColumn("seen", F.current_timestamp())
    rows.write.parquet(source)
    for _ in range(2):
        ingest.append_filtered(ingest.candidate_stream(spark, source), table, check).awaitTermination()
    assert spark.read.parquet(table).count() == 1
