"""Staged ``{meta, data}`` documents: scan, envelope parse + validation, typing.

A staged file holds one JSON document, or one document per line (which is
what a Spark writer produces); hidden / ``_``-prefixed / ``.tmp`` files never
match the ``*.json`` glob. Files of one document per line are read as lines, so
a large file is many tasks; only pretty-printed documents are read whole. Every
step is a per-row expression; the driver looks at the first line of each file.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs as FS
from ..functions.scalars import allow_duplicate_json_keys, json_map
from ..session import scratch_dir

META_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("conflict_target", T.ArrayType(T.StringType())),
    T.StructField("column_types", T.MapType(T.StringType(), T.StringType())),
    T.StructField("json_columns", T.ArrayType(T.StringType())),
    T.StructField("add_updated_at", T.BooleanType()),
    T.StructField("source", T.StringType()),
    T.StructField("collected_at", T.StringType()),
    T.StructField("window_from", T.LongType()),
    T.StructField("window_till", T.LongType()),
])
ENVELOPE_SCHEMA = T.StructType([T.StructField("meta", META_SCHEMA), T.StructField("data", T.ArrayType(T.StringType())),
                                T.StructField("_bad", T.StringType())])
#: For documents that the reader stumbles on: what their metadata say all the same.
META_ONLY = T.StructType([T.StructField("meta", META_SCHEMA), T.StructField("data", T.StringType())])

# ---- fixed values: write methods and SQL type names -------------------------------------
METHODS = ("insert", "upsert", "copy")
DEFAULT_METHOD = "upsert"
SQL_TYPES = {
    "TEXT": "string", "VARCHAR": "string", "JSONB": "string", "JSON": "string",
    "BIGINT": "bigint", "INTEGER": "int", "INT": "int", "SMALLINT": "smallint",
    "DOUBLE PRECISION": "double", "DOUBLE": "double", "REAL": "float", "NUMERIC": "double",
    "BOOLEAN": "boolean", "TIMESTAMPTZ": "timestamp", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}
# ------------------------------------------------------------------------------------------


def read_staged(spark: SparkSession, pending_dir: str, files: list[str] | None = None, folder: str | None = None) -> DataFrame:
    """One row per staged document: (file_path, doc_pos, doc).

    ``files`` restricts the scan to an explicit (e.g. bounded) list of paths. A file whose first line is a whole
    object holds a document per line: its lines are read in splits, and doc_pos is a line's number among the file's
    lines that are not blank, whatever the splits were. Any other file is one document. ``folder`` is where the numbered
    lines are kept, for a caller that removes them when it is done.
    """
    allow_duplicate_json_keys(spark)
    if files is None:
        files = [path for path, name, is_dir, _ in FS.list_dir(spark, pending_dir) if not is_dir and is_staged(name)]
    by_line = [f for f in files if _one_per_line(FS.first_line(spark, f))]
    whole = sorted(set(files) - set(by_line))
    docs = []
    if by_line:
        docs.append(_numbered(read_lines(spark, by_line), folder))
    if whole:
        docs.append(spark.read.text(whole, wholetext=True).select(
            F.col("_metadata.file_path").alias("file_path"), F.lit(0).alias("doc_pos"), F.col("value").alias("doc")))
    if not docs:
        return spark.createDataFrame([], "file_path string, doc_pos int, doc string")
    return docs[0] if len(docs) == 1 else docs[0].unionByName(docs[1])


def is_staged(name: str) -> bool:
    return name.endswith(".json") and name[0] not in "._"


def _one_per_line(first: str | None) -> bool:
    """Whether a file with this first line has a document per line. A first line that is longer than what was looked
    at is one: a pretty-printed document breaks its line early."""
    if first is None:
        return True
    try:
        return isinstance(json.loads(first), dict)
    except ValueError:
        return False


def read_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file_path, block, value) of the lines that are not blank; block: where the split of the file begins."""
    raw = spark.read.text(files, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"))
    return raw.where(F.trim("value") != "")


def _numbered(lines: DataFrame, folder: str | None = None) -> DataFrame:
    """Lines with their number in the file. Kept first: splits may fall otherwise when a scan is repeated (they depend on
    the cores at hand), the numbers don't, as each split's lines are counted as they were read."""
    lines = kept(lines.withColumn("row", F.monotonically_increasing_id()), folder or scratch_dir(lines.sparkSession, "lines"))
    blocks = lines.groupBy("file_path", "block").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file_path", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # one row per split of the scan
    placed = lines.join(F.broadcast(offsets), ["file_path", "block"])
    return placed.select("file_path", (F.col("offset") + F.col("row") - F.col("first")).cast("int").alias("doc_pos"), F.col("value").alias("doc"))


def kept(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written to ``folder`` and read back, compressed (staged text shrinks to a small part). Rows may be as large as
    a document: the writer looks at the size of its pages after each."""
    (df.write.mode("overwrite").option("compression", "zstd").option("parquet.enable.dictionary", "false")
     .option("parquet.page.size.row.check.min", "1").option("parquet.block.size.row.check.min", "1").parquet(f"{folder}/t"))
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/t")


def list_pending(spark: SparkSession, pending_dir: str, max_files: int | None = None, tried: DataFrame | None = None,
                 leave_out: frozenset[str] = frozenset()) -> tuple[list[str], int]:
    """(pending ``*.json`` files, number of files left for a later run).

    ``tried`` (file_path, tries, done): finished files are left out, and files that failed come after those that failed
    less often, by name among equals, so failing files never keep others waiting. Files in ``leave_out`` (normalised
    paths) are neither taken nor counted. At most ``max_files`` are taken. A folder that is not there has no files."""
    if not FS.exists(spark, pending_dir):
        return [], 0
    files = sorted(path for path, name, is_dir, _ in FS.list_dir(spark, pending_dir) if not is_dir and is_staged(name))
    files = [f for f in files if _norm_path(f) not in leave_out]
    if tried is not None and files:
        # the (ever-growing) ledger is cut to the listed files; one row per such file comes back
        listed = spark.createDataFrame([(_norm_path(f),) for f in files], "n string")
        known = tried.withColumn("n", normal_path("file_path")).join(F.broadcast(listed), "n", "left_semi")
        state = {r.n: r for r in known.groupBy("n").agg(F.max("tries").alias("tries"), F.min("done").alias("done")).collect()}
        files = [f for f in files if not (_norm_path(f) in state and state[_norm_path(f)].done)]
        files.sort(key=lambda f: (state[_norm_path(f)].tries if _norm_path(f) in state else 0, f))
    take = files if max_files is None else files[:max_files]
    return take, len(files) - len(take)


def normal_path(c: str) -> Column:
    """The column form of ``_norm_path``."""
    return F.regexp_replace(c, "^file:/+", "file:/")


def _norm_path(p: str) -> str:
    """'file:///x' and 'file:/x' name the same file."""
    return "file:/" + p[len("file:"):].lstrip("/") if p.startswith("file:") else p


def parse_envelope(docs: DataFrame) -> DataFrame:
    """Parse + validate each document.

    Adds ``meta`` (struct), ``method`` (lower-cased, default upsert),
    ``records`` (array of record JSON texts), ``columns`` (keys of the first
    record, in order) and ``status`` = ok / error / skipped with ``error``.
    """
    allow_duplicate_json_keys(docs.sparkSession)
    env = F.from_json(F.col("doc"), ENVELOPE_SCHEMA, {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false",
                                                      "columnNameOfCorruptRecord": "_bad"})
    # a generator of one row is a step of its own: what it computes is not taken apart into the expressions that use it,
    # each of which would parse the whole document again. The document is read once, straight into the texts of its records,
    # and a caller that drops ``doc`` has no row with the text and the records of a document
    def looked_at(e: Column) -> Column:
        # only what that reader stumbles on is looked at as a whole: JSON of another shape, or no JSON
        whole = F.try_variant_get(F.try_parse_json(F.col("doc")), "$", "struct<>").isNotNull()
        is_object = F.when(e["_bad"].isNull(), F.col("doc").rlike(r"^\s*\{")).otherwise(whole)
        return F.struct(F.when(e["_bad"].isNull(), e["meta"]).otherwise(F.from_json(F.col("doc"), META_ONLY)["meta"]).alias("_meta"),
                        e["data"].alias("_records"), F.coalesce(is_object, F.lit(False)).alias("_is_object"))
    d = docs.select("*", F.inline(F.transform(F.array(env), looked_at)))
    meta, records, data_is_list = F.col("_meta"), F.col("_records"), F.col("_records").isNotNull()
    method = F.lower(F.coalesce(meta["method"], F.lit(DEFAULT_METHOD)))
    error = (F.when(~F.col("_is_object"), F.lit("invalid JSON document"))
             .when(F.coalesce(meta["table"], F.lit("")) == "", F.lit("meta.table missing"))
             .when(~method.isin(*METHODS), F.concat(F.lit("invalid method: "), method))
             .when((method == "upsert") & (F.coalesce(F.size(meta["conflict_target"]), F.lit(0)) <= 0),
                   F.lit("upsert requires meta.conflict_target"))
             .when(~data_is_list, F.lit("data must be a list")))
    columns = F.when(F.size(records) > 0, F.array_distinct(F.json_object_keys(F.element_at(records, 1))))
    absent = F.array_except(F.coalesce(meta["conflict_target"], F.array().cast("array<string>")), columns)
    error = (F.when(error.isNotNull(), error)
             .when(F.size(records) > 0, F.when(columns.isNull(), F.lit("records must be objects"))
                   .when(F.size(absent) > 0, F.concat(F.lit("conflict_target column not in data: "), F.element_at(absent, 1)))))
    out = d.select(*docs.columns, meta.alias("meta"), method.alias("method"), records.alias("records"),
                   columns.alias("columns"), error.alias("error"))
    status = (F.when(F.col("error").isNotNull(), F.lit("error"))
              .when(F.coalesce(F.size("records"), F.lit(0)) == 0, F.lit("skipped"))
              .otherwise(F.lit("ok")))
    return out.withColumn("status", status)


def column_types(columns: list[str], json_cols: list[str], declared: dict[str, str]) -> dict[str, str]:
    """Spark type of each staged column. Later rules win: text, then names that end in ``_at`` are timestamps, JSON
    columns are text, declared SQL types (unknown names: text)."""
    types = dict.fromkeys(columns, "string")
    types.update({c: "timestamp" for c in columns if c.endswith("_at")})
    types.update({c: "string" for c in columns if c in json_cols})
    types.update({c: SQL_TYPES.get(t.upper(), "string") for c, t in declared.items() if c in types})
    return types


def typed_value(text: Column, spark_type: str) -> Column:
    """Record text as a column type; NULL where it is none (``records_frame`` then names the column)."""
    if spark_type == "string":
        return text
    if spark_type in ("bigint", "int", "smallint"):
        # integral text only; '1.5' or '1e3' do not silently truncate
        return F.when(text.rlike(r"^\s*-?[0-9]+\s*\z"), F.trim(text).try_cast(spark_type))
    return text.try_cast(spark_type)


def records_frame(docs: DataFrame, types: dict[str, str], json_columns: list[str] = (), key: list[str] = ()) -> DataFrame:
    """Explode documents into typed rows over the columns of ``types``.

    A document's columns are those of its first record (``columns``); extra keys of later records are dropped, missing
    keys and columns of other documents are NULL. A column that is JSON in the row's document (``meta.json_columns``;
    ``json_columns`` names all that are in some document) holds the value as JSON text whatever its type (a string
    keeps its quotes; JSON ``null`` is SQL NULL). ``_file``, ``_doc`` and ``_pos`` keep the load order, ``_columns`` the
    document's columns. ``_bad`` says what is wrong with a row: a value that is not of its column's type, or a NULL in
    a column of ``key``.
    """
    rec = docs.select(F.col("file_path").alias("_file"), F.col("doc_pos").alias("_doc"), F.col("columns").alias("_columns"),
                      F.coalesce(F.col("meta.json_columns"), F.array().cast("array<string>")).alias("_json"),
                      F.posexplode("records").alias("_pos", "_rec"))
    extra = [F.try_parse_json(F.col("_rec")).alias("_v")] if json_columns else []
    # out of a generator of one row, so that a record is parsed once and not once for each column
    r = rec.select("_file", "_doc", "_pos", "_columns", "_json", F.explode(F.array(json_map(F.col("_rec")))).alias("_m"), *extra)
    texts, bad = {}, []
    for c, t in types.items():
        text = F.when(F.array_contains("_columns", c), F.element_at(F.col("_m"), c))
        value = typed_value(text, t)
        if c in json_columns:
            jv = F.try_variant_get(F.col("_v"), "$['" + c.replace("'", "\\'") + "']", "variant")
            is_json = F.array_contains("_json", c) & F.array_contains("_columns", c)
            value = F.when(is_json, typed_value(F.when(~F.is_variant_null(jv), F.to_json(jv)), t)).otherwise(value)
        if t != "string":
            bad.append(F.when(text.isNotNull() & value.isNull(), F.lit(f"invalid value for column {c} ({t})")))
        if c in key:
            bad.append(F.when(text.isNull(), F.lit(f"null value in key column {c}")))
        texts[c] = value
    return r.select("_file", "_doc", "_pos", "_columns", (F.coalesce(*bad) if bad else F.lit(None).cast("string")).alias("_bad"),
                    *[v.alias(c) for c, v in texts.items()])
