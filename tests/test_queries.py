"""Every registered query against its SQL, and the driver contract."""

import time
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from sheetloom import harness, scratch
from sheetloom.oracle import ORACLE
from sheetloom.plans.bundle import REGULAR_EDGES
from sheetloom.queries import QUERIES
from sheetloom.sources.staging import Staging

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, database, name):
    got = contract.queries()[name](spark, SF)
    columns = sorted(got.columns)
    rows = Counter(tuple(r[c] for c in columns) for r in got.collect())
    found = database.execute(contract.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert rows == Counter(tuple(r[i] for i in places) for r in found.fetchall())
    assert rows


def test_entry(spark):
    assert contract.entry(spark).count() == QUERIES[contract.FLAGSHIP](spark, SF).count() > 5000


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", ["analyte_sheet", "heterogeneous_union", "dangling_links", "bundle_read_back"])
def test_nothing_is_left_of_a_query(spark, tmp_path, name):
    with scratch(spark, str(tmp_path / "shared")) as folder:
        assert QUERIES[name](spark, SF).count() > 0
        assert list((tmp_path / "shared").iterdir()) and folder.startswith(str(tmp_path))
    assert not list((tmp_path / "shared").iterdir())


def test_nothing_is_left_of_a_failure_and_settings_are_put_back(spark, tmp_path):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    with pytest.raises(ZeroDivisionError), scratch(spark, str(tmp_path)) as folder:
        spark.conf.set(setting, "7")
        spark.range(5).checkpoint()
        harness.staging(spark)(QUERIES["donor_sheet"](spark, SF), "donors")
        assert len(list(Path(folder).iterdir())) == 2
        1 / 0
    assert not list(tmp_path.iterdir()) and spark.conf.get(setting) == before
    spark.range(5).checkpoint()
    harness.staging(spark)(QUERIES["donor_sheet"](spark, SF), "donors")
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize(
    "name, table, columns",
    [
        ("bundle_read_back", "samples", "collaborator_sample_id donor_id"),
        ("regular_from_files", "rows", "sample_id cram_path donor_id collaborator_sample_id input_bam"),
        ("codec_from_files", "rows", "sample_id collaborator_sample_id MolConsensusBAM RAW_BAM donor_id vcf"),
        ("codec_dangling_links", "samples", "collaborator_sample_id donor_id RAW_BAM MolConsensusBAM vcf"),
    ],
)
def test_a_query_stages_the_columns_it_reads(spark, monkeypatch, name, table, columns):
    """The first table that is staged has these and the place of a row, which is one number."""

    class Seen(Exception):
        pass

    def staged(self, df, called):
        assert called == table and set(df.columns) == {*columns.split(), "file_ord", "block", "pos"}
        assert df.schema["pos"].dataType.simpleString() == "bigint"
        raise Seen

    monkeypatch.setattr(harness.Staging, "__call__", staged)
    with pytest.raises(Seen):
        QUERIES[name](spark, SF)


def test_file_sets_stage_what_is_read_twice_only(spark, monkeypatch):
    staged, write = [], Staging.__call__

    def noted(self, df, name):
        staged.append(name)
        return write(self, df, name)

    monkeypatch.setattr(Staging, "__call__", noted)
    with scratch(spark):
        assert contract.queries()["fileset_sheet_linked"](spark, SF).count()
    assert staged == ["samples"]


def shuffled(spark):
    """Shuffle files on disk, with their bytes."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f: f.stat().st_size for f in map(Path, files) if f.name.startswith("shuffle_") and f.exists()}


def bytes_left(spark, before):
    """Bytes of shuffle files that are not among ``before``; Spark removes them a moment after an execution."""
    for _ in range(40):
        left = sum(size for f, size in shuffled(spark).items() if f not in before)
        if left < 20_000:
            break
        time.sleep(0.25)
    return left


@pytest.mark.parametrize("name", ["regular_from_files", "codec_from_files"])
def test_a_workflow_keeps_nothing_on_disk_that_is_done_with(spark, tmp_path, monkeypatch, name):
    """Neither shuffles of what is written, nor rows and manifests that were read: the disk holds one sheet's work at a time."""
    before, written, write = shuffled(spark), [], Staging.__call__

    def noted(self, df, called):
        staged = write(self, df, called)
        if called.startswith("sum_"):
            written.append(called)
            assert bytes_left(spark, before) < 20_000
        return staged

    monkeypatch.setattr(Staging, "__call__", noted)
    with scratch(spark, str(tmp_path)) as folder:
        rows = QUERIES[name](spark, SF).collect()
        assert len(written) == len(rows) > 9
        (root,) = [p for p in Path(folder).iterdir() if (p / "in").exists()]
        assert sorted(p.name for p in (root / "in").iterdir()) == ["donors", "tissues"] and not (root / "rows").exists()


def test_a_bundle_keeps_no_shuffles(spark, tmp_path):
    """Of all that is done before the bundle is read, that is staging and writing."""
    before = shuffled(spark)
    with scratch(spark, str(tmp_path)):
        QUERIES["bundle_read_back"](spark, SF)
        assert bytes_left(spark, before) < 20_000


def test_a_report_on_links_holds_the_shuffles_of_one_sheet(spark, tmp_path, monkeypatch):
    """Whenever a sheet or a target is done, its shuffles are gone, and in the end all ids are, too."""
    before, steps, write = shuffled(spark), [], Staging.__call__

    def noted(self, df, called):
        staged = write(self, df, called)
        steps.append(called)
        assert bytes_left(spark, before) < 20_000
        return staged

    monkeypatch.setattr(Staging, "__call__", noted)
    with scratch(spark, str(tmp_path)) as folder:
        assert QUERIES["dangling_links"](spark, SF).count() == len(REGULAR_EDGES)
        assert any(step.startswith("links_to_") for step in steps) and not list(Path(folder).glob("*/ids_of_*"))
