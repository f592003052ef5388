import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from assocspark.plans.bgz_files import _block, write_bgzf
from assocspark.schemas import TABLES
from assocspark.sources import text
from assocspark.sources.bgzf import read_bgzf_lines
from assocspark.sources.quoted import read_records

HLA = [c for c in TABLES["hla_associations"].columns if c != "dataset"]
COLOC = TABLES["coloc_credsets"].columns


def hla(chrom="6", gene="HLA-A", mlogp="1.5", phenotype="P"):
    values = dict.fromkeys(HLA, "NA") | {"chr": chrom, "pos": "3", "gene": gene, "allele": "A*01:01", "phenotype": phenotype, "mlogp": mlogp}
    return "\t".join(values[c] for c in HLA)


def put(folder, lines, name="f.tsv.gz", header="\t".join(HLA), skip=1):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if name.endswith("gz") else open
    with opener(path, "wt") as out:
        out.write("\n".join([header] * skip + lines) + "\n")
    return path


def load(spark, path, **options):
    return text.load_frame(spark, "hla_associations", path, {"dataset": "d"}, **options)


def test_null_text_empty_text_and_quoted_newlines(spark, folder):
    path = put(folder, [hla(phenotype="NA2"), hla(phenotype=""), hla(phenotype='"a\nb"'), hla(chrom="chrX", mlogp="NA", phenotype='""')])
    rows = load(spark, path, quoted_newlines=True).select("chr", "phenotype", "mlogp", "pval", "dataset").collect()
    assert [tuple(r) for r in rows] == [
        (6, "NA2", 1.5, None, "d"), (6, "", 1.5, None, "d"), (6, "a\nb", 1.5, None, "d"), (23, "", None, None, "d"),
    ]


def test_quotes_are_doubled_and_backslashes_are_plain(spark, folder):
    path = put(folder, [hla(phenotype='"a ""b"" \\"'), hla(phenotype="c\\d"), hla(phenotype='"x\ty"')])
    assert [r[0] for r in load(spark, path).select("phenotype").collect()] == ['a "b" \\', "c\\d", "x\ty"]


def test_result_has_registry_order_types_and_comments(spark, folder):
    df = load(spark, put(folder, [hla()]))
    spec = TABLES["hla_associations"].schema
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in spec]
    assert [f.metadata["comment"] for f in df.schema] == [f.metadata["comment"] for f in spec]
    assert all(f.metadata["comment"] for t in TABLES.values() for f in t.schema)


@pytest.mark.parametrize(
    "line, error",
    [
        ("6\t3\tHLA-A", "Malformed"),
        (hla() + "\textra", "Malformed"),
        (hla(mlogp="high"), "not a double"),
        (hla(chrom="GL1"), "hla_associations.chr is required"),
        (hla(gene="NA"), "hla_associations.gene is required"),
        (hla().replace("\t3\t", "\t1.0\t"), "not a bigint"),
        (hla(mlogp=""), "not a double"),
    ],
)
def test_bad_rows_fail_the_load(spark, folder, line, error):
    with pytest.raises(Exception, match=error):
        load(spark, put(folder, [hla(), line])).collect()


def test_leading_rows_are_skipped_per_file(spark, folder):
    for skip in (0, 1, 3):
        for i in range(3):
            put(folder, [hla(phenotype=f"p{i}"), hla(phenotype="q")], f"s{skip}/{i}.tsv.gz", skip=skip)
        rows = load(spark, f"{folder}/s{skip}/*.tsv.gz", skip_leading_rows=skip)
        assert sorted(r["phenotype"] for r in rows.collect()) == ["p0", "p1", "p2", "q", "q", "q"]


def test_plain_text_without_quoted_newlines_is_split(spark, folder):
    path = put(folder, [hla(phenotype=f"p{i}") for i in range(5_000)], "f.tsv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = load(spark, path, quoted_newlines=False)
        assert df.rdd.getNumPartitions() > 2
        assert df.count() == 5_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_unknown_names_are_refused(spark):
    with pytest.raises(ValueError, match="unknown table"):
        text.load_frame(spark, "nothing", "x")
    with pytest.raises(ValueError, match="not in table"):
        text.load_frame(spark, "mpra", "x", {"nope": "1"})
    with pytest.raises(ValueError, match="not supported"):
        text.load_frame(spark, "gene_annotations", "x", {"symbol": "1"})


def test_string_reader_goes_by_name_and_keeps_commas_in_quotes(spark, folder):
    with open(f"{folder}/f.csv", "w") as out:
        out.write('id,abbreviation,name\n1,,"a, ""b"""\n2,x,\n')
    rows = [tuple(r) for r in text.read_strings(spark, f"{folder}/f.csv", ",").collect()]
    assert rows == [("1", None, 'a, "b"'), ("2", "x", None)]


def bgz(path, lines, block):
    data = ("\n".join(lines) + "\n").encode()
    with open(path, "wb") as out:
        for at in range(0, len(data), block):
            out.write(_block(data[at : at + block]))
        out.write(_block(b""))


@pytest.mark.parametrize("block, split", [(37, 64), (37, 301), (1_000, 64), (1_000, 5_000), (60_000, 1 << 20), (11, 9)])
def test_block_gzip_is_split_without_losing_lines(spark, folder, block, split):
    rows = 3_000 if split > 1_000 else 60 if split > 10 else 9
    lines = ["header"] + [f"{i}-" + "x" * (i % 90) for i in range(rows)]
    bgz(f"{folder}/f.bgz", lines, block)
    df = read_bgzf_lines(spark, f"{folder}/f.bgz", 1, split_bytes=split)
    assert df.rdd.getNumPartitions() > 1 or os.path.getsize(f"{folder}/f.bgz") <= split
    assert sorted(r["value"] for r in df.collect()) == sorted(lines[1:])


def test_long_lines_cross_blocks_and_ranges(spark, folder):
    lines = ["header"] + [c * 5_000 for c in "abcdefg"]
    bgz(f"{folder}/f.bgz", lines, 700)
    df = read_bgzf_lines(spark, f"{folder}/f.bgz", 1, split_bytes=256)
    assert sorted(r["value"] for r in df.collect()) == lines[1:]


def test_last_line_without_newline_and_no_plain_gzip_under_the_suffix(spark, folder):
    with open(f"{folder}/a.bgz", "wb") as out:
        out.write(_block(b"h\nx\ny"))
    found = read_bgzf_lines(spark, f"{folder}/*.bgz", 1, split_bytes=40)
    assert sorted(r["value"] for r in found.collect()) == ["x", "y"]
    with open(f"{folder}/b.bgz", "wb") as out:
        out.write(gzip.compress(b"h\nu\n") + gzip.compress(b"v\n" * 50_000 + b"w"))
    with pytest.raises(Exception, match="not a block-gzip file"):
        read_bgzf_lines(spark, f"{folder}/*.bgz", 1, split_bytes=40).count()


def test_block_gzip_table_load_equals_the_gzip_one(spark, folder):
    values = {"dataset": "d", "data_type": "GWAS", "trait": "", "trait_original": "t", "cell_type": "NA", "chr": "1", "pos": "2", "ref": "A", "alt": "G"}
    line = "\t".join({**dict.fromkeys(COLOC, "0.5"), **values}[c] for c in COLOC)
    path = put(folder, [line] * 3, "g/f.tsv.gz", header="\t".join(COLOC))
    bgz(f"{folder}/f.tsv.bgz", ["\t".join(COLOC)] + [line] * 3, 50)
    blocks = text.load_frame(spark, "coloc_credsets", f"{folder}/f.tsv.bgz", block_gzip=True)
    assert blocks.collect() == text.load_frame(spark, "coloc_credsets", path).collect()


def test_block_gzip_writer_leaves_whole_files_only(spark, folder):
    df = spark.range(10_000).repartition(3).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    assert write_bgzf(df, f"{folder}/out") == 10_000
    assert sorted(os.path.splitext(n)[1] for n in os.listdir(f"{folder}/out")) == [".bgz"] * 3
    assert read_bgzf_lines(spark, f"{folder}/out/*.bgz").count() == 10_000


def quoted_lines(n):
    """Rows with quoted line ends at every place, doubled quotes, and one field longer than many ranges."""
    rng = random.Random(n)
    for k in range(n):
        value = rng.choice([f"p{k}", f'"p{k}\na"', f'"p{k}\n\n""x""\n"', f'"{k}\r\nb\tc"', f'"""{k}"', '""'])
        yield hla(phenotype=f'"{"long line" + chr(10)}{"y" * 3_000}{chr(10) * 50}"' if k == n // 2 else value)


@pytest.mark.parametrize("split", [37, 512, 4_000, 1 << 20])
def test_quoted_newlines_over_ranges_equal_the_whole_file(spark, folder, split):
    lines = list(quoted_lines(150))
    for k, part in enumerate((lines[:100], lines[100:], [])):
        put(f"{folder}/plain", part, f"f{k}.tsv")
        put(f"{folder}/packed", part, f"f{k}.tsv.gz")
    whole = load(spark, f"{folder}/packed", quoted_newlines=True)
    cut = load(spark, f"{folder}/plain", quoted_newlines=True, split_bytes=split)
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect())) and whole.count() == 150
    both = load(spark, [f"{folder}/plain", f"{folder}/packed"], quoted_newlines=True, split_bytes=split)
    assert both.count() == 300


@pytest.mark.parametrize("block, split", [(50, 64), (700, 300), (700, 1 << 20)])
def test_quoted_newlines_in_block_gzip(spark, folder, block, split):
    lines = list(quoted_lines(60))
    data = ("\n".join(["\t".join(HLA), *lines]) + "\n").encode()
    with open(f"{folder}/f.bgz", "wb") as out:
        for at in range(0, len(data), block):
            out.write(_block(data[at : at + block]))
        out.write(_block(b""))
    whole = load(spark, put(folder, lines, "whole.tsv.gz"), quoted_newlines=True)
    cut = load(spark, f"{folder}/f.bgz", quoted_newlines=True, block_gzip=True, split_bytes=split)
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


def test_quoted_file_is_read_by_many_tasks_without_a_final_line_end(spark, folder):
    path = f"{folder}/one.tsv"
    with open(path, "w") as out:
        out.write("skip\nalso\n" + "\n".join(f'"{k}\n{"z" * 90}"\t{k}' for k in range(3_000)))
    found = read_records(spark, path, skip_leading_rows=2, split_bytes=20_000)
    tasks = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(t["count"] for t in tasks) == 3_000 and len(tasks) >= 8
    assert {r[0].split("\t")[1] for r in found.collect()} == {str(k) for k in range(3_000)}


def test_a_region_reads_only_its_ranges(spark, folder):
    from assocspark.sources import bgzf

    def row(k):
        return "\t".join(["d", "t", "x", "x", "NA", str(23 if k >= 8_000 else k // 2_000 + 1), str(k % 2_000 * 10), "A", "G", "1.5", "0.1", "NA", "0.5", f"cs{k}"])

    data = "\n".join(["\t".join(COLOC), *[row(k) for k in range(10_000)]]).encode() + b"\n"
    with open(f"{folder}/f.bgz", "wb") as out:
        for at in range(0, len(data), 3_000):
            out.write(_block(data[at : at + 3_000]))
        out.write(_block(b""))
    text.index_regions(spark, "coloc_credsets", f"{folder}/f.bgz", f"{folder}/index", granule=4_096)
    everything = text.load_frame(spark, "coloc_credsets", f"{folder}/f.bgz", block_gzip=True)
    unpacked = spark.sparkContext.accumulator(0)

    class Counted:
        def __init__(self, source):
            self.source = source

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.source.close()

        def seek(self, at):
            self.source.seek(at)

        def read(self, n):
            found = self.source.read(n)
            if n == 1 << 16:  # a block
                unpacked.add(1)
            return found

    def opened(path):
        return Counted(bgzf.opened(path))

    blocks = -(-len(data) // 3_000)
    for chrom, first, last in ((23, 5_000, 6_000), (1, 0, 10), (3, 19_990, 30_000), (4, 7, 9), (9, 0, 10**9)):
        before = unpacked.value
        found = text.load_region(spark, "coloc_credsets", f"{folder}/index", chrom, first, last, opened=opened)
        expected = everything.filter((F.col("chr") == chrom) & F.col("pos").between(first, last))
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
        assert unpacked.value - before < blocks / 4
    assert everything.filter("chr = 23").count() == 2_000
