"""Golden values of the gene build."""

import datetime

import pytest

from assocspark.operators import genes
from assocspark.sources import text

# A family graph with a diamond: 620 has two parents, which share their own one; 710 stands alone.
PARENTS = {512: [], 540: [512], 544: [512], 620: [540, 544], 633: [544], 710: []}
MEMBERS = {"TAU": [620], "RHO": [633, 710], "SIGMA": [512], "PHI": []}
PLACES = {"TAU": ("chr12", 88_000, 91_250, "-"), "RHO": ("Y", 150, 4_020, "+"), "SIGMA": ("KI270728.1", 9, 77, "+")}
BUILD = {"gencode_version": "31", "hgnc_version": "2019-11-05", "download_date": "2019-12-24"}


def strings(spark, columns, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in columns.split())).coalesce(1)


def ancestors(family):
    """(ancestor, distance) of a family, itself at distance 0."""
    found, edge = {family: 0}, [family]
    while edge:
        edge = [p for f in edge for p in PARENTS[f] if found.setdefault(p, found[f] + 1) == found[f] + 1]
    return found


def accession(symbol):
    return f"ENSG{7_000 + 13 * list(MEMBERS).index(symbol):011d}"


@pytest.fixture
def inputs(spark):
    genes_of = [(k, f"HGNC:{9_000 + k}", symbol) for k, symbol in enumerate(MEMBERS)]
    return {
        "hgnc": strings(
            spark, "hgnc_id symbol name ensembl_gene_id alias_symbol prev_symbol locus_type entrez_id",
            *[(i, s, f"{s.lower()} protein", f"{accession(s)}.{k + 2}", f'"{s}x|{s}y"', None if k % 2 else f"old{s}", "RNA, long", f"{k}77") for k, i, s in genes_of],
        ),
        "gencode": strings(
            spark, "gene_id chrom gene_start gene_end gene_strand",
            *[(f"{accession(s)}.{40 - k}", c, str(b), str(e), d) for k, (s, (c, b, e, d)) in enumerate(PLACES.items())],
        ),
        "gene_has_family": strings(spark, "hgnc_id family_id", *[(i.removeprefix("HGNC:"), str(f)) for _, i, s in genes_of for f in MEMBERS[s]]),
        "closure": strings(
            spark, "parent_fam_id child_fam_id distance", *[(str(p), str(f), str(d)) for f in PARENTS for p, d in ancestors(f).items()]
        ),
        "family": strings(spark, "id abbreviation name", *[(str(f), f"F{f}", f"family no. {f}") for f in PARENTS]),
    }


def build(inputs, **changes):
    rows = genes.build_genes(**{**inputs, **changes}, **BUILD).collect()
    return {r["symbol"]: r.asDict() for r in rows}


def test_every_column_of_every_gene(inputs):
    found, codes = build(inputs), {"chr12": 12, "Y": 24}
    assert set(found) == set(MEMBERS)
    for k, (symbol, own) in enumerate(MEMBERS.items()):
        lineage = sorted({a for f in own for a in ancestors(f)})
        chrom, start, end, strand = PLACES.get(symbol, (None, None, None, None))
        assert found[symbol] == {
            "hgnc_id": f"HGNC:{9_000 + k}", "symbol": symbol, "name": f"{symbol.lower()} protein",
            "prev_symbols": None if k % 2 else f"old{symbol}", "alias_symbols": f"{symbol}x|{symbol}y",
            "ensembl_gene_id": accession(symbol), "ncbi_gene_id": f"{k}77", "chr": codes.get(chrom), "gene_start": start,
            "gene_end": end, "strand": strand, "locus_type": "RNA, long", "gene_group_ids": lineage,
            "gene_group_names": [f"family no. {f}" for f in lineage], "gencode_version": "31", "hgnc_version": "2019-11-05",
            "download_date": datetime.date(2019, 12, 24),
        }


def test_ancestors_are_distinct_pairs_without_self_and_bad_rows(spark, inputs):
    expected = {(f, a) for f in PARENTS for a in ancestors(f) if a != f}
    assert {tuple(r) for r in genes.family_ancestors(inputs["closure"]).collect()} == expected
    more = inputs["closure"].union(strings(spark, "a b c", ("633", "633", "4"), (None, "540", "1"), ("fam", "540", "1"), ("512", "620", "2")))
    assert genes.family_ancestors(more).count() == len(expected)


def test_last_coordinates_win_and_empty_ids_do_not_match(spark, inputs):
    again = strings(spark, "a b c d e", (f"{accession('TAU')}.99", "chr3", "61", "far", None), (".8", "5", "5", "6", "-"))
    hgnc = inputs["hgnc"].union(strings(spark, "a b c d e f g h", ("HGNC:9900", "IOTA", "i", "", None, None, "t", None)))
    found = build(inputs, gencode=inputs["gencode"].union(again).coalesce(1), hgnc=hgnc)
    assert [found["TAU"][c] for c in ("chr", "gene_start", "gene_end", "strand")] == [3, 61, None, None]
    assert [found["IOTA"][c] for c in ("chr", "ensembl_gene_id", "gene_group_ids", "gene_group_names")] == [None, None, [], []]


def test_file_order_decides_over_several_splits(spark, folder):
    rows = "".join(f"ENSG{i % 50}.{i}\tchr1\t{i}\t{i}\t+\n" for i in range(20_000))
    with open(f"{folder}/g.tsv", "w") as out:
        out.write("gene_id\tchrom\tgene_start\tgene_end\tgene_strand\n" + rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        split = spark.read.options(sep="\t", header=True).csv(f"{folder}/g.tsv")
        assert split.rdd.getNumPartitions() > 3
        tagged = genes.in_file_order(split)
        found = {r["ensembl_key"]: r["gene_start"] for r in genes.gene_coordinates(tagged).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {f"ENSG{k}": 19_950 + k for k in range(50)}


def test_unnamed_family_stays_aligned_and_unknown_one_is_dropped(spark, inputs):
    family = strings(spark, "id abbreviation name", ("512", "", "first"), ("620", "", None), ("512", "", "second"), ("six", "", "no number"))
    found = build(inputs, family=family)["TAU"]
    assert (found["gene_group_ids"], found["gene_group_names"]) == ([512, 620], ["second", None])


def test_key_is_canonical_but_the_id_is_stored_as_read(spark, inputs):
    spelled = ["\thgnc: 9000", "9000", "Hgnc:9000 "]
    rows = [(i, f"S{k}", "n", None, "t") for k, i in enumerate(spelled)] + [("HGNC:9001", "", "n", None, "t"), ("HGNC:9001", None, "n", None, "t")]
    found = build(inputs, hgnc=strings(spark, "hgnc_id symbol name ensembl_gene_id locus_type", *rows))
    assert {s: r["hgnc_id"] for s, r in found.items()} == {f"S{k}": i for k, i in enumerate(spelled)}
    assert all(r["gene_group_ids"] == sorted(ancestors(620)) for r in found.values())


def test_repeated_memberships_collapse(spark, inputs):
    many = inputs["gene_has_family"].union(strings(spark, "a b", *[("HGNC:9001", "633")] * 1_000, ("9001", "544")))
    lineage = sorted({a for f in (633, 710) for a in ancestors(f)})
    assert build(inputs, gene_has_family=many)["RHO"]["gene_group_ids"] == lineage


def test_ndjson_round_trip_keeps_null_keys_and_empty_arrays(spark, inputs, folder):
    built = genes.build_genes(**inputs, **BUILD)
    text.write_ndjson(built, f"{folder}/genes")
    lines = [r[0] for r in spark.read.text(f"{folder}/genes").collect()]
    assert sum('"chr":null' in line for line in lines) == 2  # no coordinates, and an unplaced contig
    loaded = text.load_frame(spark, "gene_annotations", f"{folder}/genes")
    assert sorted(map(str, loaded.collect())) == sorted(map(str, built.collect()))
    check = genes.lineage_present(loaded).first()
    assert (check["genes"], check["with_groups"], check["ok"]) == (4, 3, True)
