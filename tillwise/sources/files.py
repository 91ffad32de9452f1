"""Raw and cleaned tables on disk, result export, and typed loading."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise import model
from tillwise.functions.dates import with_month
from tillwise.functions.relations import union_all
from tillwise.model import RetailTables
from tillwise.operators import validation
from tillwise.operators.cleaning import require_columns
from tillwise.operators.validation import ValidationError

# Cell texts a CSV reader treats as missing.
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
_EXACT_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
PARTITIONED = {"sales": "order_date", "inventory": "date"}


def _load_all(load, names: Sequence[str], what: str) -> dict[str, DataFrame]:
    """Load every table, or fail once naming all that are absent."""
    found, missing = {}, []
    for name in names:
        try:
            found[name] = load(name)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(name)
    if missing:
        raise FileNotFoundError(f"missing {what}: {', '.join(missing)}")
    return found


_BAD = "__bad_line"


def _raw_lines(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """A raw CSV table as text, with ``__bad_line``: the line, where it has not one cell per column.

    While that column is read no other is skipped, so every line is counted out in full. Spark
    refuses to read it alone, so none of another column's characters are added to it.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    names = spark.read.options(**options, inferSchema=False).csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _BAD]])
    # With the schema given and not enforced, every part file's header is held against it.
    df = (
        spark.read.schema(text)
        .options(**options, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, columnPruning=False)
        .csv(path)
    )
    return df.select(
        *[F.when(F.col(f"`{c}`").isin(*MISSING_TEXT), None).otherwise(F.col(f"`{c}`")).alias(c) for c in names],
        F.concat(F.col(_BAD), F.substring(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), 1, 0)).alias(_BAD),
        F.col("_metadata.file_path").alias("__file"),
    )


def _cells(line: Column) -> Column:
    """Cells of a CSV line: commas outside quotes, and one. Doubled quotes close and open again."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.char_length(bare) - F.char_length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def read_raw(
    spark: SparkSession, directory: str, multi_line: bool = False, pad_short: bool = False
) -> dict[str, DataFrame]:
    """The six raw CSV tables with headers; every column is read as text, none is inferred.

    Part files of one table must have one header; another order of columns is an error. A line with
    more or fewer cells than the header fails the query that meets it, naming table, file and line;
    :func:`split_raw` keeps such lines apart instead. ``pad_short`` admits short lines, their last
    columns missing.

    ``multi_line`` admits line breaks inside quoted cells, but then a file is one task.
    """

    def load(name: str) -> DataFrame:
        df = _raw_lines(spark, f"{directory}/{name}.csv", multi_line)
        columns = [c for c in df.columns if c not in (_BAD, "__file")]
        fits = F.col(_BAD).isNull()
        if pad_short:
            fits = fits | (_cells(F.col(_BAD)) < len(columns))
        what = F.concat(
            F.lit(f"{name}: {len(columns)} cells expected, "), _cells(F.col(_BAD)).cast("string"),
            F.lit(" found in "), F.col("__file"), F.lit(": "), F.col(_BAD),
        )
        return df.filter(F.when(fits, True).otherwise(F.raise_error(what))).select(*columns)

    return _load_all(load, model.TABLES, "raw CSV files")


def split_raw(
    spark: SparkSession,
    directory: str,
    multi_line: bool = False,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The raw CSV tables without malformed lines, and those lines.

    The second result has (table, file, cells, expected, line) for every line that has not one cell
    per column; together with the tables it holds every line. ``keep`` writes a table once, such as
    :func:`stage`, so that the files are not read for either result anew.
    """

    def load(name: str) -> DataFrame:
        df = _raw_lines(spark, f"{directory}/{name}.csv", multi_line)
        return keep(df, f"raw-{name}") if keep else df

    lines = _load_all(load, model.TABLES, "raw CSV files")
    good, bad = {}, []
    for name, df in lines.items():
        columns = [c for c in df.columns if c not in (_BAD, "__file")]
        good[name] = df.filter(F.col(_BAD).isNull()).select(*columns)
        bad.append(
            df.filter(F.col(_BAD).isNotNull()).select(
                F.lit(name).alias("table"),
                F.col("__file").alias("file"),
                _cells(F.col(_BAD)).alias("cells"),
                F.lit(len(columns)).alias("expected"),
                F.col(_BAD).alias("line"),
            )
        )
    return good, union_all(bad)


def write_raw(tables: Mapping[str, DataFrame], directory: str) -> None:
    """Write text tables as CSV folders, keeping the white space around cells."""
    for name, df in tables.items():
        _formatted(df.write, "csv").mode("errorifexists").save(f"{directory}/{name}.csv")


def _formatted(writer, fmt: str):
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"unknown format {fmt}")
    return writer.format(fmt).options(**(_EXACT_CSV if fmt == "csv" else {}))


def write_cleaned(
    t: RetailTables, directory: str, fmt: str = "parquet", by_month: Sequence[str] = ()
) -> None:
    """A folder per table, as Parquet or CSV; the two large facts are partitioned by month.

    Rows are rebalanced on the month first, so writers get even shares whatever the
    month sizes are. Facts named in ``by_month`` are read as they are from files partitioned by
    month, such as staged or stored ones: a task that reads them holds the months of its files alone,
    so they are written without that shuffle, with a file at most per file read and task.
    """
    for name in t.names():
        df = t.table(name)
        if name in PARTITIONED:
            if name in by_month and "month" not in df.columns:
                raise ValueError(f"{name} has no column month, so it is not read by month")
            df = with_month(df, PARTITIONED[name])
            if name not in by_month:
                df = df.hint("rebalance", F.col("month"))
            writer = df.write.partitionBy("month")
        else:
            writer = df.write
        _formatted(writer, fmt).mode("overwrite").save(f"{directory}/{name}")


def cleaned_schemas(t: RetailTables | None = None) -> dict[str, T.StructType]:
    """Schemas of the cleaned files: the model's, or those of a given star."""
    out = {}
    for name in t.names() if t else model.TABLES:
        fields = list(t.table(name).schema if t else model.CLEAN_SCHEMAS[name])
        fields = [f for f in fields if f.name != "month"]
        if name in PARTITIONED:
            fields.append(T.StructField("month", T.StringType()))
        out[name] = T.StructType(fields)
    return out


def read_cleaned(
    spark: SparkSession,
    directory: str,
    schemas: Mapping[str, T.StructType] | None = None,
    unknown_customer: object = model.UNKNOWN_CUSTOMER,
    fmt: str = "parquet",
) -> RetailTables:
    """The cleaned tables with fixed schemas; CSV headers must name the schema's columns."""
    schemas = schemas or cleaned_schemas()
    options = {"header": True, "escape": '"', "enforceSchema": False} if fmt == "csv" else {}
    tables = _load_all(
        lambda name: spark.read.schema(schemas[name])
        .format(fmt)
        .options(**options)
        .load(f"{directory}/{name}"),
        list(schemas),
        "cleaned tables",
    )
    return RetailTables(unknown_customer=unknown_customer, **tables)


def typed_table(df: DataFrame, name: str, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` by name, cast losslessly; ``month`` follows the fact's date."""
    found = require_columns(df, name, [f.name for f in schema if f.name != "month"])
    if "month" in schema.names:
        found = with_month(found, PARTITIONED[name])
    return found.to(schema)


def load_tables(
    tables: Mapping[str, DataFrame],
    schemas: Mapping[str, T.StructType],
    prefix: str = "",
    unknown_customer: object = model.UNKNOWN_CUSTOMER,
    check: bool = False,
) -> RetailTables:
    """Bind frames to typed views, parents before children.

    Columns are matched by name and cast losslessly; extra columns are dropped and a
    missing or incompatible one is an error. ``check`` also compares row counts with the
    source and looks for rows without a parent, and fails naming what is wrong.
    """
    out = {}
    for name in model.TABLES:
        typed = typed_table(tables[name], name, schemas[name])
        typed.createOrReplaceTempView(f"{prefix}{name}")
        out[name] = typed
    loaded = RetailTables(unknown_customer=unknown_customer, **out)
    if check:
        source = RetailTables(unknown_customer=unknown_customer, **{n: tables[n] for n in model.TABLES})
        _check_loaded(source, loaded)
    return loaded


def _check_loaded(source: RetailTables, loaded: RetailTables) -> None:
    """Fail unless every row arrived and every key has its parent; one row per rule is read."""
    counts = validation.reconcile_row_counts(source, loaded).filter(~F.col("matches")).collect()
    keys = validation.check_foreign_keys(loaded).unionByName(validation.check_composite_foreign_key(loaded))
    wrong = [f"{r['table']}: {r.source_rows} rows became {r.loaded_rows}" for r in counts]
    wrong += [f"{r['table']}: {r.rule} ({r.violations} rows)" for r in keys.filter("violations > 0").collect()]
    if wrong:
        raise ValidationError("loading failed:\n" + "\n".join(f"  - {w}" for w in wrong))


def write_cleaning_summary(summary: DataFrame, path: str) -> None:
    """The long summary (table, metric, value) as JSON lines."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def read_cleaning_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("table string, metric string, value long").json(path)


def export_results(
    frames: Mapping[str, DataFrame], directory: str, fmt: str = "parquet"
) -> None:
    """One folder per named result, as Parquet or CSV."""
    for name, df in frames.items():
        _formatted(df.write, fmt).mode("overwrite").save(f"{directory}/{name}")


def verify_export(
    spark: SparkSession, directory: str, expected: Sequence[str], fmt: str = "parquet"
) -> DataFrame:
    """(name, has_rows) of every expected result; absent ones are an error."""
    reader = spark.read.options(header=True) if fmt == "csv" else spark.read
    frames = _load_all(
        lambda n: reader.format(fmt).load(f"{directory}/{n}"), expected, "exported results"
    )
    return union_all(
        [
            df.limit(1)
            .agg((F.count(F.lit(1)) > 0).alias("has_rows"))
            .select(F.lit(name).alias("name"), "has_rows")
            for name, df in frames.items()
        ]
    )
