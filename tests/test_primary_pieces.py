"""Of a contig's pieces of equal places the primary does not hang on the order of rows."""

from strandmill.operators import alignments


def test_the_primary_is_the_same_in_any_order(spark):
    rows = [("a", 0, "c", 5, 900, (k, 300, 9 - k), 60 - k) for k in range(8)]
    schema = "qname string, flag int, chrom string, start long, stop long, clip struct<left:int,mapped:int,right:int>, mapq int"
    for own in (rows, rows[::-1], rows[3:] + rows[:3]):
        pairs = alignments.segment_pairs(spark.createDataFrame(own, schema).coalesce(1), assembly=True).collect()
        assert {r["p"]["clip"]["left"] for r in pairs} == {0} and len(pairs) == 7
