"""Reading, writing, loading and exporting."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.small_star import raw_tables, tiny_star
from tillcheck.registry import _contents, file_queries
from tillwise import model
from tillwise.operators import cleaning
from tillwise.plans import slicing
from tillwise.sources import files, staging


@pytest.fixture(scope="module")
def star(spark):
    return tiny_star(spark)


def same(a, b):
    columns = [c for c in a.columns if c != "month"]
    return sorted(map(tuple, a.select(columns).collect()), key=str) == sorted(
        map(tuple, b.select(columns).collect()), key=str
    )


def test_raw_csv_to_cleaned_parquet(spark, tmp_path):
    raw_dir, clean_dir = str(tmp_path / "raw"), str(tmp_path / "clean")
    files.write_raw(raw_tables(spark), raw_dir)
    raw = files.read_raw(spark, raw_dir, multi_line=True)
    for name, df in raw_tables(spark).items():
        # Blank cells come back as missing; everything else is kept to the last space.
        blank = [F.when(F.trim(c) == "", None).otherwise(F.col(c)).alias(c) for c in df.columns]
        assert same(raw[name].select(blank), df.select(blank)), name
    assert set(raw) == set(model.TABLES)
    assert {t for df in raw.values() for _, t in df.dtypes} == {"string"}
    cleaned = cleaning.cleaned_tables(cleaning.clean_all(raw))
    files.write_cleaned(cleaned, clean_dir)
    back = files.read_cleaned(spark, clean_dir)
    for name in model.TABLES:
        assert same(back.table(name), cleaned.table(name)), name
    assert dict(back.sales.dtypes)["month"] == "string"


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_formats_round_trip(spark, star, tmp_path, fmt):
    path = str(tmp_path / fmt)
    files.write_cleaned(star, path, fmt)
    back = files.read_cleaned(spark, path, files.cleaned_schemas(star), fmt=fmt)
    for name in model.TABLES:
        assert same(back.table(name), star.table(name)), name
    files.export_results({"a": star.stores}, f"{path}-out", fmt)
    assert files.verify_export(spark, f"{path}-out", ["a"], fmt).first().has_rows
    with pytest.raises(ValueError, match="xlsx"):
        files.write_cleaned(star, path, "xlsx")


def test_facts_that_lie_by_month_are_written_without_a_shuffle(spark, star, tmp_path, monkeypatch):
    files.write_cleaned(star, str(tmp_path / "first"))
    lying = files.read_cleaned(spark, str(tmp_path / "first"), files.cleaned_schemas(star))
    hinted, hint = [], type(star.sales).hint
    monkeypatch.setattr(type(star.sales), "hint", lambda df, name, *more: hinted.append(name) or hint(df, name, *more))
    files.write_cleaned(lying, str(tmp_path / "second"), by_month=("sales", "inventory"))
    assert not hinted
    back = files.read_cleaned(spark, str(tmp_path / "second"), files.cleaned_schemas(star))
    for name in model.TABLES:
        assert same(back.table(name), star.table(name)), name
    assert all("/month=" in f for f in back.sales.inputFiles())
    files.write_cleaned(lying, str(tmp_path / "third"))
    assert hinted == ["rebalance", "rebalance"]
    with pytest.raises(ValueError, match="sales has no column month"):
        files.write_cleaned(lying.replace(sales=lying.sales.drop("month")), str(tmp_path / "fourth"), by_month=("sales",))


def test_month_filter_prunes_partitions(spark, star, tmp_path):
    files.write_cleaned(star, str(tmp_path / "clean"))
    back = files.read_cleaned(spark, str(tmp_path / "clean"))
    january = slicing.slice_star(back, date_from="2024-01-01", date_to="2024-01-31").sales
    assert january.count() == 1
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_all_missing_tables_are_named(spark, star, tmp_path):
    with pytest.raises(FileNotFoundError, match="customers, products, stores, sales, inventory, returns"):
        files.read_raw(spark, str(tmp_path))
    files.export_results({"stores": star.stores}, str(tmp_path))
    with pytest.raises(FileNotFoundError, match="customers, products, sales, inventory, returns"):
        files.read_cleaned(spark, str(tmp_path))


def test_missing_texts_read_as_null(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name in model.TABLES:
        header = ",".join(model.RAW_COLUMNS[name])
        cells = ",".join(["NA", "nan", "None", "ok", "", "N/A", "NULL", "null"][: len(model.RAW_COLUMNS[name])])
        (folder / f"{name}.csv").write_text(f"{header}\n{cells}\n")
    row = files.read_raw(spark, str(folder))["stores"].first()
    assert tuple(row) == (None, None, None, "ok", None, None)


def damaged_folder(tmp_path):
    """Stores with good, short, long, quoted and blank lines; the other tables have a good line each."""
    folder = tmp_path / "raw"
    folder.mkdir()
    for name in model.TABLES:
        header = model.RAW_COLUMNS[name]
        (folder / f"{name}.csv").write_text(f"{','.join(header)}\n{','.join('x' * len(header))}\n")
    stores = folder / "stores.csv"
    stores.write_text(
        stores.read_text()
        + 'S1,"a, b",c,d,e,f\nS2,b,c,d,e,f,EXTRA,X\nS3,b\n\nS4,"say ""hi, you""",c,d,e,f\n'
        + 'S5,"a, b",c,d,e,f,"more, yet"\nS6,,,,,\nS7,b,c,d,e,f,\n'
    )
    return str(folder)


def test_malformed_lines_fail_by_name(spark, tmp_path):
    folder = damaged_folder(tmp_path)
    raw = files.read_raw(spark, folder)
    assert raw["products"].count() == 1
    for query in (raw["stores"], raw["stores"].select("store_id")):
        with pytest.raises(Exception, match="stores: 6 cells expected, (8|2|7) found in .*stores.csv: S"):
            query.collect()
    (tmp_path / "raw" / "stores.csv").write_text(",".join(model.RAW_COLUMNS["stores"]) + "\nS3,b\n")
    with pytest.raises(Exception, match="2 found"):
        files.read_raw(spark, folder)["stores"].collect()
    padded = files.read_raw(spark, folder, pad_short=True)["stores"].collect()
    assert [tuple(r) for r in padded] == [("S3", "b", None, None, None, None)]


@pytest.mark.parametrize("keep", [None, staging.stage])
def test_malformed_lines_are_kept_apart(spark, tmp_path, keep):
    good, bad = files.split_raw(spark, damaged_folder(tmp_path), keep=keep)
    assert {r.store_id: r.store_name for r in good["stores"].collect()} == {
        "x": "x", "S1": "a, b", "S4": 'say "hi, you"', "S6": None,
    }
    assert all(good[n].count() == 1 and good[n].columns == model.RAW_COLUMNS[n] for n in good if n != "stores")
    got = {r.line: (r.table, r.cells, r.expected, r.file.rsplit("/", 1)[1]) for r in bad.collect()}
    assert got == {
        "S2,b,c,d,e,f,EXTRA,X": ("stores", 8, 6, "stores.csv"), "S3,b": ("stores", 2, 6, "stores.csv"),
        'S5,"a, b",c,d,e,f,"more, yet"': ("stores", 7, 6, "stores.csv"), "S7,b,c,d,e,f,": ("stores", 7, 6, "stores.csv"),
    }


def test_malformed_line_over_several_lines(spark, tmp_path):
    folder = damaged_folder(tmp_path)
    (tmp_path / "raw" / "stores.csv").write_text(
        ",".join(model.RAW_COLUMNS["stores"]) + '\nS1,"two\nlines",c,d,e,f\nS2,"two\nlines, too",c,d,e,f,g\n'
    )
    good, bad = files.split_raw(spark, folder, multi_line=True)
    assert [r.store_name for r in good["stores"].collect()] == ["two\nlines"]
    assert [(r.cells, r.line) for r in bad.collect()] == [(7, 'S2,"two\nlines, too",c,d,e,f,g')]


def test_load_tables_checks_and_casts(spark, star):
    frames = {n: star.table(n) for n in model.TABLES}
    frames["stores"] = star.stores.withColumn("surplus", star.stores.city)
    loaded = files.load_tables(frames, files.cleaned_schemas(star), prefix="t_")
    assert loaded.stores.columns == star.stores.columns
    assert spark.table("t_stores").count() == 2
    assert loaded.sales.filter("month = '2023-01'").count() == 3
    frames["stores"] = star.stores.drop("city").withColumnRenamed("store_type", "kind")
    with pytest.raises(ValueError, match="stores lacks required columns: city, store_type"):
        files.load_tables(frames, files.cleaned_schemas(star))
    frames["stores"] = star.stores.withColumn("opening_date", star.stores.city)
    with pytest.raises(Exception, match="opening_date"):
        files.load_tables(frames, files.cleaned_schemas(star))


def test_export_and_verify(spark, star, tmp_path):
    path = str(tmp_path / "out")
    files.export_results({"a": star.stores, "b": star.stores.limit(0)}, path)
    assert {tuple(r) for r in files.verify_export(spark, path, ["a", "b"]).collect()} == {("a", True), ("b", False)}
    with pytest.raises(FileNotFoundError, match="c, d"):
        files.verify_export(spark, path, ["a", "c", "d"])


def test_summary_round_trip(spark, tmp_path):
    summary = cleaning.cleaning_summary(cleaning.clean_all(raw_tables(spark)))
    path = str(tmp_path / "summary")
    files.write_cleaning_summary(summary, path)
    assert same(files.read_cleaning_summary(spark, path), summary)


class FakeContext:
    applicationId = "app-1"

    def __init__(self, master):
        self.master = master


class FakeSession:
    def __init__(self, master, folder=None):
        self.sparkContext = FakeContext(master)
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}


def test_staging_uses_the_named_shared_folder():
    assert staging.shared_dir(FakeSession("yarn", "s3://b/cp/")) == "s3://b/cp/tillwise/app-1"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_dir(FakeSession("yarn"))
    assert staging.shared_dir(FakeSession("local[2]")).endswith("/app-1")


def test_staging_keeps_rows_and_types(star):
    assert same(staging.stage(star.sales, "sales"), star.sales)
    by_store = staging.stage(star.sales, "sales", ["store_id"])
    assert same(by_store, star.sales) and by_store.dtypes == star.sales.dtypes


def test_raw_part_files_must_agree_on_the_header(spark, tmp_path):
    files.write_raw(raw_tables(spark), str(tmp_path))
    other = tmp_path / "stores.csv" / "part-other.csv"
    other.write_text("store_name,store_id,city,province,store_type,opening_date\nX,STORE09,T,ON,Urban,2020-01-01\n")
    with pytest.raises(Exception, match="header"):
        files.read_raw(spark, str(tmp_path))["stores"].collect()


def test_loaded_star_keeps_the_unknown_member_and_is_checked(star):
    frames = {n: star.table(n) for n in model.TABLES}
    loaded = files.load_tables(frames, files.cleaned_schemas(star), "t_", unknown_customer="C2", check=True)
    assert loaded.unknown_customer == "C2"
    broken = {**frames, "products": star.products.filter("product_id <> 'P1'")}
    with pytest.raises(AssertionError, match="sales: foreign_key:product_id->products"):
        files.load_tables(broken, files.cleaned_schemas(star), "t_", check=True)


def test_content_shows_damage_in_every_table(star):
    assert {"write_cleaned_content", "load_tables_content"} <= set(file_queries())
    whole = {r.table_name: r for r in _contents(star).collect()}
    assert set(whole) == set(model.TABLES)
    for name in model.TABLES:
        df = star.table(name)
        key = df.columns[0]
        one = df.select(key).first()[0]
        for damaged in (df.filter(F.col(key) != F.lit(one)), df.withColumn(df.columns[1], F.lit(None).cast(df.dtypes[1][1]))):
            got = {r.table_name: r for r in _contents(star.replace(**{name: damaged})).collect()}
            assert {n for n in got if got[n] != whole[n]} == {name}
