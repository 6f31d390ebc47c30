"""Files in and out."""

import csv
import gzip
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheetloom import read_manifests, strip_file, write_bundle, write_sheet
from sheetloom import schemas
from sheetloom.operators.tissues import with_tissue
from sheetloom.sources.manifests import manifest, read_codec, read_tissues, tag_manifest
from sheetloom.sources.strip import strip_metrics, strip_paths
from sheetloom.sources.tables import (
    NA_TOKENS,
    cells_of,
    column_names,
    files_of,
    in_file_order,
    read_table,
    scan_tables,
    surplus_cells,
    survey,
)
from tests.data import long_file, plain_rows, rna_file, rows_of, short_file, tissue_file, tsv


def written(path):
    """Lines of a written sheet, part files in name order; every part repeats the header."""
    header, body = None, []
    for part in sorted(path.glob("part-*")):
        with open(part, newline="") as f:
            rows = list(csv.reader(f, delimiter="\t"))
        header = rows[0]
        body += rows[1:]
    return header, body


def test_cells_blank_lines_and_line_ends(spark, tmp_path):
    body = "k\tv w\r\n1\tNA\r\n\r\n2\tNA x\r\n3\t\r\n4\t\"q \"\"z\"\r\n5\r\n6\t null\r\n7\t\t\r\n\t\r\n8\t'"
    path = tmp_path / "t 1%.tsv"
    path.write_bytes(body.encode())
    got = rows_of(read_table(spark, str(path)), "k", "v w")
    assert got[:7] == [("1", None), ("2", "NA x"), ("3", None), ("4", 'q "z'), ("5", None), ("6", " null"), ("7", None)]
    assert got[-1] == ("8", "'")


def test_every_missing_token(spark, tmp_path):
    tokens = [t for t in NA_TOKENS if t]
    path = tsv(tmp_path / "t.tsv", ["i", "v"], [[i, t] for i, t in enumerate(tokens)] + [["x", "na"], ["y", "none"]])
    assert rows_of(read_table(spark, path), "v") == [None] * len(tokens) + ["na", "none"]
    assert rows_of(scan_tables(spark, [path], missing=False), "v") == [*tokens, "na", "none"]


@pytest.mark.parametrize("split", ["200b", "1k", "128m"])
def test_row_order_over_split_sizes_and_files(spark, tmp_path, split):
    files = [short_file(tmp_path / f"short_{i}.tsv", [f"D{i}-3A-{n:04d}" for n in range(120)]) for i in (3, 1, 2)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = read_manifests(spark, short_read=files)
        if split != "128m":
            assert rows.rdd.getNumPartitions() > 3
        got = rows_of(rows, "collaborator_sample_id")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [f"D{i}-3A-{n:04d}" for i in (3, 1, 2) for n in range(120)]


def test_blocks_cut_a_file_that_cannot_be_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sheetloom.sources.tables.BLOCK_BITS", 4)
    path = tmp_path / "t.tsv.gz"
    path.write_bytes(gzip.compress(("k\n" + "".join(f"{i}\n" for i in range(100))).encode()))
    rows = read_table(spark, str(path))
    assert rows_of(rows, "k") == [str(i) for i in range(100)]
    assert rows.select("block").distinct().count() == 7


def test_columns_bind_by_name_and_may_be_missing(spark, tmp_path):
    a = short_file(tmp_path / "short.tsv", ["D-3A-1"])
    b = long_file(tmp_path / "long.tsv", ["D-3S-2"])
    c = rna_file(tmp_path / "rna.tsv", ["D-3Q-3"])
    rows = read_manifests(spark, [a], [b], [c])
    got = rows_of(rows, "collaborator_sample_id", "cram_path", "input_bam", "description")
    assert got == [
        ("D-3A-1", "sr_D-3A-1_0.cram", None, "SM-0"),
        ("D-3S-2", None, "m0.hifi_reads.bam", "LR-0"),
        ("D-3Q-3", "D-3Q-3.cram", None, "D-3Q-3"),
    ]


def test_empty_sample_id_cell_stays_empty(spark, tmp_path):
    header = ["sample_id", "donor_id", "collaborator_sample_id", "cram_path"]
    path = tsv(tmp_path / "short.tsv", header, [[None, "D", "D-3A-1", "x.cram"], ["NA", "D", "D-3A-2", "x.cram"]])
    assert rows_of(read_manifests(spark, [path]), "description") == [None, None]


def test_table_of_several_files(spark, tmp_path):
    for name in ("b", "a", "c"):
        tsv(tmp_path / "t" / f"{name}.tsv", ["k"], [[f"{name}{i}"] for i in range(3)])
    rows = read_table(spark, str(tmp_path / "t"))
    assert rows_of(rows, "file_ord", "k") == [(i, f"{n}{j}") for i, n in enumerate("abc") for j in range(3)]


def test_tissue_file_is_broadcast_by_its_size(spark, tmp_path):
    """No hint: Spark knows from the file size that the dimension is small, and shuffles no sample by code."""
    samples = read_manifests(spark, [short_file(tmp_path / "short.tsv", ["D-3A-1"])])
    labelled = with_tissue(samples, read_tissues(spark, tissue_file(tmp_path)))
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin [core" in plan


def test_directory_argument_reads_files_by_name(spark, tmp_path):
    for name in ("b", "a", "c"):
        short_file(tmp_path / "short" / f"{name}.tsv", [f"D-3A-{name}"])
    rows = read_manifests(spark, [str(tmp_path / "short")])
    assert rows_of(rows, "collaborator_sample_id") == ["D-3A-a", "D-3A-b", "D-3A-c"]


def test_one_file_under_two_names(spark, tmp_path):
    path = short_file(tmp_path / "short.tsv", ["D-3A-1", "D-3A-2"])
    other = str(tmp_path / "." / "x" / ".." / "short.tsv").replace("/x/..", "/./")
    rows = read_manifests(spark, [path, other])
    assert rows_of(rows, "collaborator_sample_id", "for_analyte") == [("D-3A-1", True), ("D-3A-2", True)] * 2
    short_file(tmp_path / "more.tsv", ["D-3A-3"])
    rows = read_manifests(spark, [path, str(tmp_path)])  # the file is read once, and comes for each argument
    assert rows_of(rows, "collaborator_sample_id") == ["D-3A-1", "D-3A-2", "D-3A-3", "D-3A-1", "D-3A-2"]


HEADERS = (["sample_id", "cram_path", "donor_id", "collaborator_sample_id"], ["collaborator_sample_id", "sample_id", "donor_id", "cram_path"])


def test_every_file_is_bound_by_its_own_header(spark, tmp_path):
    for i, header in enumerate(HEADERS):
        rows = [[{"sample_id": f"s{i}{n}", "cram_path": f"p{i}{n}.cram", "donor_id": "D1", "collaborator_sample_id": f"D1-3A-{i}{n}"}[c]
                 for c in header] for n in range(3)]
        tsv(tmp_path / "in" / f"{i}.tsv", header, rows)
    got = rows_of(read_manifests(spark, [str(tmp_path / "in")]), "collaborator_sample_id", "cram_path", "description")
    assert got == [(f"D1-3A-{i}{n}", f"p{i}{n}.cram", f"s{i}{n}") for i in range(2) for n in range(3)]


def test_headers_that_differ_by_case(spark, tmp_path):
    header = ["Sample_id", "sample_id", "donor_id", "collaborator_sample_id", "cram_path"]
    path = tsv(tmp_path / "short.tsv", header, [["other", "own", "D", "D-3A-1", "x.cram"]])
    assert rows_of(read_manifests(spark, [path]), "description") == ["own"]
    with pytest.raises(ValueError, match="letter case"):
        read_table(spark, path)


def test_header_names(spark, tmp_path):
    assert column_names('a\t"b\tc"\t\ta\ta') == ("a", "b\tc", "_c2", "a.1", "a.2")
    path = tsv(tmp_path / "t [1] {x}*.tsv", ["k", "k", ""], [[1, 2, 3]])
    rows = read_table(spark, str(tmp_path))
    assert [tuple(r)[:3] for r in rows.select("k", "`k.1`", "_c2").collect()] == [("1", "2", "3")] and path


def test_line_break_in_a_quoted_cell(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sheetloom.sources.tables.BLOCK_BITS", 2)
    body = 'k\tv\n1\t"a\nb"\n2\t"c ""x""\n\t"\n3\tplain "quote" \n4\t""\n' + "".join(f"{i}\tz\n" for i in range(5, 30))
    (tmp_path / "broken.tsv").write_text(body)
    (tmp_path / "whole.tsv").write_text('v\tk\n"a ""b"""\t1\nx"y\t2\n')
    assert sorted(broken for _, broken in survey(spark, files_of(spark, str(tmp_path)))) == [False, True]
    got = rows_of(read_table(spark, str(tmp_path)), "k", "v")
    assert got[:4] == [("1", "a\nb"), ("2", 'c "x"\n\t'), ("3", 'plain "quote" '), ("4", None)]
    assert [k for k, _ in got[4:29]] == [str(i) for i in range(5, 30)]
    assert got[29:] == [("1", 'a "b"'), ("2", 'x"y')]


def test_closed_quotes_do_not_keep_a_file_whole(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('k\tv\n1\t"a ""b"""\n2\t""\n3\t"x"\n')
    assert [broken for _, broken in survey(spark, files_of(spark, str(tmp_path)))] == [False]


@pytest.mark.parametrize("stray", ['5" tube', 'a"b"c', 'x""', '"a"b', '"a" ', '""', '""""', '"a""b"', 'it""s 5"', '"tab\there"'])
def test_a_stray_quote_does_not_keep_a_file_whole(spark, tmp_path, stray):
    lines = ["k\tv\tw", *[f"{i}\t{stray if i == 70 else i}\t{stray if i == 40 else 'z'}" for i in range(200)]]
    (tmp_path / "t.tsv").write_text("\n".join(lines) + "\n")
    assert [broken for _, broken in survey(spark, files_of(spark, str(tmp_path)))] == [False]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    try:
        rows = read_table(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 3
        got = rows_of(rows, "k", "v", "w")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = {'"a"b': '"a"b', '"a" ': '"a" ', '""': None, '""""': '"', '"a""b"': 'a"b', '"tab\there"': "tab\there"}.get(stray, stray)
    assert got == [(str(i), expected if i == 70 else str(i), expected if i == 40 else "z") for i in range(200)]


@pytest.mark.parametrize("cell", ['"a\nb"', '"\n"', '"a""\n"', '"""\n"""', '"tab\t\n\t"', '"\r\n"'])
@pytest.mark.parametrize("before", ["", '5"\t', '"q"\t', '""\t', '"a"b\t'])
def test_a_line_break_is_found_behind_any_cell(spark, tmp_path, cell, before):
    (tmp_path / "t.tsv").write_bytes(f"k\tv\tw\n1\t2\t3\n{before}{cell}\tx\n4\t5\t6\n".encode())
    assert [broken for _, broken in survey(spark, files_of(spark, str(tmp_path)))] == [True]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='a" \\', max_size=6), min_size=1, max_size=5), min_size=1, max_size=30))
def test_cells_of_a_written_line(spark, rows):
    """Cells of lines that a writer of tables wrote, over any quotes."""
    held = io.StringIO()
    csv.writer(held, delimiter="\t", lineterminator="\n").writerows(rows)
    lines = held.getvalue().split("\n")[:-1]
    got = spark.createDataFrame(list(enumerate(lines)), "i int, line string").select("i", cells_of(F.col("line")).alias("cells"))
    found = {r["i"]: r["cells"] for r in got.collect()}
    expected = [["" if c is None else c for c in found[i]] for i in range(len(lines))]
    assert expected == rows


def test_a_cell_of_very_many_quotes(spark):
    line = '1\t"' + '""x' * 50_000 + '"\t' + 'y"' * 50_000
    cells = spark.createDataFrame([(line,)], "line string").select(cells_of(F.col("line")).alias("c")).first()["c"]
    assert cells == ["1", '"x' * 50_000, 'y"' * 50_000]


def test_surplus_cells_are_an_error_or_kept(spark, tmp_path):
    body = "A\tB\n/x/p.cram\t1\n/y/q.cram\t2\textra\tNA\n/z/r.cram\t3\t\t\n"
    (tmp_path / "a.tsv").write_text(body)
    (tmp_path / "b.tsv").write_text('C\tA\tB\n1\t2\t"3\n"\t\t"too\nmuch"\n4\n5\t6\t7\n')
    path = str(tmp_path)
    for count in (lambda: read_table(spark, path).count(), lambda: scan_tables(spark, [f"{path}/b.tsv"], columns=["C"]).collect()):
        with pytest.raises(Exception, match="more cells than the header has names: (extra; NA in .*a.tsv|too\nmuch in .*b.tsv)"):
            count()
    rows = scan_tables(spark, [path], surplus="keep").orderBy("file", "block", "pos")
    assert [tuple(r) for r in rows.select("A", "B", "C", "surplus").collect()] == [
        ("/x/p.cram", "1", None, None), ("/y/q.cram", "2", None, ["extra", "NA"]), ("/z/r.cram", "3", None, None),
        ("2", "3\n", "1", ["too\nmuch"]), (None, None, "4", None), ("6", "7", "5", None),
    ]
    found = surplus_cells(spark, [path]).orderBy("file").collect()
    assert [(r["file"].rpartition("/")[2], r["surplus"]) for r in found] == [("a.tsv", ["extra", "NA"]), ("b.tsv", ["too\nmuch"])]
    with pytest.raises(Exception, match="more cells than the header has names"):
        strip_file(spark, f"{path}/a.tsv", str(tmp_path / "out"))
    with pytest.raises(ValueError, match="error or keep"):
        scan_tables(spark, [path], surplus="drop")


@pytest.mark.parametrize("batch", [20_000, 50])
def test_many_headers_take_one_scan(spark, tmp_path, monkeypatch, batch):
    monkeypatch.setattr("sheetloom.sources.tables.MAPPED_FILES", batch)
    for i in range(200):
        names = [f"c{j}" for j in range(i % 7)] + ["k"] + [f"own{i}"]
        tsv(tmp_path / f"{i:03d}.tsv", names, [[f"{i}.{n}.{c}" for c in names] for n in range(3)])
    rows = scan_tables(spark, [str(tmp_path)])
    assert len(rows.columns) == 6 + 1 + 200 + 3
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == (1 if batch == 20_000 else 4)
    got = {r["k"]: r.asDict() for r in rows.collect()}
    assert len(got) == 600
    for i in range(200):
        for n in range(3):
            names = {f"c{j}" for j in range(i % 7)} | {"k", f"own{i}"}
            row = got[f"{i}.{n}.k"]
            assert {c: v for c, v in row.items() if v is not None and c not in ("file", "block", "pos")} == {c: f"{i}.{n}.{c}" for c in names}


@pytest.mark.parametrize("files", [2, 150])
def test_a_file_that_comes_late_is_not_read(spark, tmp_path, files):
    for i in range(files):
        tsv(tmp_path / "in" / f"{i:04d}.tsv", ["k"], [[i]])
    rows = read_table(spark, str(tmp_path / "in"))
    tsv(tmp_path / "in" / "0000a.tsv", ["k"], [["late"]])
    assert rows_of(rows, "file_ord", "k") == [(i, str(i)) for i in range(files)]


@pytest.mark.parametrize("files", [2, 150])
def test_a_row_of_an_unlisted_file_is_an_error(spark, files):
    rows = spark.createDataFrame([("f0", 1), ("late", 2)], "file string, v int")
    with pytest.raises(Exception, match="not a listed file: late"):
        in_file_order(rows, [f"f{i}" for i in range(files)]).collect()


def test_files_without_a_line(spark, tmp_path):
    tsv(tmp_path / "b.tsv", ["k"], [[1]])
    (tmp_path / "a.tsv").write_text("")
    assert rows_of(read_table(spark, str(tmp_path)), "file_ord", "k") == [(1, "1")]
    with pytest.raises(ValueError, match="no file with a header"):
        read_table(spark, str(tmp_path / "a.tsv"))


def test_codec_file_without_a_path_column(spark, tmp_path):
    path = tsv(tmp_path / "codec.tsv", ["collaborator_sample_id", "donor_id", "vcf"], [["D-3A-1", "D", "x.vcf"]])
    assert plain_rows(read_codec(spark, [path, path])) == [
        {"collaborator_sample_id": "D-3A-1", "donor_id": "D", "RAW_BAM": None, "MolConsensusBAM": None, "vcf": "x.vcf"}
    ] * 2
    with pytest.raises(ValueError):
        read_codec(spark, [])


def tags(spark, given):
    rows = [(i, i, 0, kind, path, path) for i, (kind, path) in enumerate(given)]
    files = spark.createDataFrame(rows, "file_ord int, arg_ord int, sub_ord int, kind string, path string, file string")
    return [r.asDict() for r in tag_manifest(files).orderBy("file_ord").collect()]


def test_three_readings_of_a_file_name(spark):
    given = [("short_read", "in/a_SHORT.tsv"), ("short_read", "a.tsv"), ("long_read", "b_long.tsv"), ("long_read", "b.tsv"),
             ("rna", "x.tsv"), ("rna", "TruSeq.tsv"), ("rna", "watchmaker_truseq.tsv")]
    got = tags(spark, given)
    assert [t["analyte_label"] for t in got] == [
        "GDNA_SHORTREAD", "GDNA_SHORTREAD", "GDNA_LONGREAD", "GDNA_LONGREAD", "RNA_WATCHMAKER", "RNA_TRUSEQ", "RNA_TRUSEQ",
    ]
    assert [t["file_set_type"] for t in got] == [
        "WGS_ILLUMINA", "WGS_ILLUMINA", "WGS_PACBIO", "WGS_ILLUMINA", "RNA_WATCHMAKER", "RNA_TRUSEQ", "RNA_WATCHMAKER",
    ]
    assert [t["for_file_set"] for t in got] == [True] * 5 + [False] * 2
    assert [(t["for_aligned"], t["aligned_type"]) for t in got[:5]] == [
        (True, "WGS_ILLUMINA"), (True, "WGS_PACBIO"), (False, None), (True, "WGS_PACBIO"), (True, "RNA_WATCHMAKER"),
    ]
    assert [t["for_aligned"] for t in got[5:]] == [False, False]
    assert [t["for_unaligned"] for t in got] == [False, False, True, False, False, False, False]


def test_path_given_twice(spark):
    got = tags(spark, [("short_read", "s.tsv"), ("short_read", "t.tsv"), ("long_read", "s.tsv"), ("rna", "s.tsv")])
    assert [t["for_analyte"] for t in got] == [True, True, False, False]
    assert got[0]["analyte_label"] == "RNA_WATCHMAKER"
    assert [t["for_aligned"] for t in got] == [True, True, False, False]
    assert got[0]["aligned_type"] == "RNA_WATCHMAKER"
    assert [t["for_file_set"] for t in got] == [True] * 4


def test_no_rna_argument(spark):
    got = tags(spark, [("short_read", "s.tsv"), ("long_read", "long.tsv")])
    assert [t["for_file_set"] for t in got] == [True, True]
    assert [t["for_aligned"] for t in got] == [True, False]


def test_no_file_at_all(spark):
    with pytest.raises(ValueError):
        manifest(spark)


def test_sheet_round_trip(spark, tmp_path):
    values = ['q"z', '"lead', " pad ", "a\\b", "NA", "x,y", "tab\there", "-"]
    sheet = spark.createDataFrame(
        [(0, 0, i, v, None) for i, v in enumerate(values)], "file_ord int, block long, pos long, v string, blank string"
    )
    write_sheet(sheet.repartition(3), str(tmp_path / "out"))
    assert written(tmp_path / "out") == (["v", "blank"], [[v, ""] for v in values])


def test_sheet_is_written_in_row_order(spark, tmp_path):
    rows = [(i // 40, i // 10 % 4, i % 10, str(i)) for i in range(120)]
    sheet = spark.createDataFrame(rows[::-1], "file_ord int, block long, pos long, v string").repartition(5)
    write_sheet(sheet, str(tmp_path / "out"))
    assert [r[0] for r in written(tmp_path / "out")[1]] == [r[3] for r in rows]


def test_empty_sheet_has_its_header(spark, tmp_path):
    write_sheet(spark.createDataFrame([], schemas.UNALIGNED_READS), str(tmp_path / "out"))
    assert written(tmp_path / "out") == (schemas.UNALIGNED_READS.names, [])


def test_bundle(spark, tmp_path):
    donors = spark.createDataFrame([("d1", "TRUE"), ("d2", "true")], "submitted_id string, tpc_submitted string")
    empty = spark.createDataFrame([], schemas.SOFTWARE)
    write_bundle({"Donor": donors, "Software": empty}, str(tmp_path / "b"))
    assert sorted(written(tmp_path / "b" / "Donor")[1]) == [["d1", "True"], ["d2", "True"]]
    assert written(tmp_path / "b" / "manifest")[1] == [
        ["0", "(Donor)", "submitted_id,tpc_submitted", "2"],
        ["1", "Software", ",".join(schemas.SOFTWARE.names), "0"],
    ]


def test_strip_file(spark, tmp_path):
    header = ["id", "vcf", "cram_path", "RAW_BAM", "note"]
    rows = [["1", "", "gs://a/b.cram", "", "a/b"], ["2", "C:\\x\\y.vcf", "NA", "", "NA"], ["3", "z/", "c.cram", "", ""]]
    metrics = strip_file(spark, tsv(tmp_path / "in.tsv", header, rows), str(tmp_path / "out"))
    assert metrics == {"rows_processed": 3, "path_columns": ["cram_path", "vcf"]}
    assert written(tmp_path / "out") == (
        header,
        [["1", "", "b.cram", "", "a/b"], ["2", "y.vcf", "NA", "", "NA"], ["3", "", "c.cram", "", ""]],
    )


def test_strip_file_keeps_columns_that_differ_by_case(spark, tmp_path):
    header, rows = ["vcf", "VCF", "cram_path", "Cram_Path"], [["/a/b.vcf", "/a/c.vcf", "", "/x/y.cram"], ["1", "2", "/p/q.cram"]]
    source = tsv(tmp_path / "in.tsv", header, rows)
    assert strip_file(spark, source, str(tmp_path / "out")) == {"rows_processed": 2, "path_columns": ["vcf", "cram_path"]}
    assert written(tmp_path / "out") == (header, [["b.vcf", "/a/c.vcf", "", "/x/y.cram"], ["1", "2", "q.cram", ""]])
    metrics = strip_file(spark, source, str(tmp_path / "own"), columns=["VCF", "Cram_Path"])
    assert metrics == {"rows_processed": 2, "path_columns": ["VCF", "Cram_Path"]}
    assert written(tmp_path / "own")[1] == [["/a/b.vcf", "c.vcf", "", "y.cram"], ["1", "2", "/p/q.cram", ""]]
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_strip_file_with_a_broken_record(spark, tmp_path):
    (tmp_path / "in.tsv").write_text('id\tcram_path\n"s\n1"\t/a/b.cram\n2\t/c/d.cram\n')
    metrics = strip_file(spark, str(tmp_path / "in.tsv"), str(tmp_path / "out"))
    assert metrics == {"rows_processed": 2, "path_columns": ["cram_path"]}
    assert written(tmp_path / "out") == (["id", "cram_path"], [["s\n1", "b.cram"], ["2", "d.cram"]])


def test_strip_without_path_columns(spark):
    rows = spark.createDataFrame([(0, 0, 0, "a/b")], "file_ord int, block long, pos long, note string")
    assert [r.note for r in strip_paths(rows).collect()] == ["a/b"]
    assert tuple(strip_metrics(rows).first()) == (1, "")


def test_strip_paths_on_a_stream(spark, tmp_path):
    tsv(tmp_path / "in" / "a.tsv", ["id", "vcf"], [["1", "gs://a/b.vcf"], ["2", None]])
    lines = spark.readStream.schema("id string, vcf string").option("sep", "\t").option("header", True)
    query = (
        strip_paths(lines.csv(str(tmp_path / "in")))
        .writeStream.format("memory")
        .queryName("stripped")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    assert sorted(map(tuple, spark.table("stripped").collect())) == [("1", "b.vcf"), ("2", None)]


def test_strip_metrics_order_within_a_row(spark):
    rows = spark.createDataFrame(
        [(0, 0, 1, "v", "c"), (0, 0, 0, "", "")], "file_ord int, block long, pos long, vcf string, cram_path string"
    )
    assert tuple(strip_metrics(rows).first()) == (2, "cram_path, vcf")
