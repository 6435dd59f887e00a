"""Agent payload normalisation as column expressions (no Python UDFs).

Input: one row per received payload ``(request_id, received_at, raw_payload_ref,
body)`` where ``body`` is the JSON text. Everything below is per-row work
(``from_json`` / Variant type checks / higher-order functions), so it runs
inside the scan stage. Request-level strictness needs the record and weak
record counts of the whole request; all records of a request come from one
payload row, so they are computed on that row before the explode and routing
needs no shuffle.

JSON typing: object key order matters (first record's keys, prefix-vote
tie-break), and Variant sorts keys, so text values and key order come from
``from_json(..., 'map<string,string>' / 'array<string>')`` while the JSON
*type* of a value comes from Variant casts (empty struct = object, array<variant> =
array; ``schema_of_variant`` only for scalar class values).
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import agent_mapping as AM
from ..functions.scalars import allow_duplicate_json_keys, bound, iso_utc, json_map, utc_time

REC_SCHEMA = "map<string,string>"


def _lit_map(d: dict) -> Column:
    if not d:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def _jtype(variant: Column) -> Column:
    """'OBJECT' / 'ARRAY' / 'STRING' / ... of a variant value (NULL when missing)."""
    return F.regexp_extract(F.schema_of_variant(variant), r"^([A-Z]+)", 1)


def _path(key: str | None) -> str:
    return "$" if key is None else "$['" + key.replace("'", "\\'") + "']"


def is_object(v: Column, key: str | None = None) -> Column:
    """The (sub)value is a JSON object: a cast to an empty struct succeeds only for objects
    and, unlike ``schema_of_variant``, does not walk the value."""
    return F.try_variant_get(v, _path(key), "struct<>").isNotNull()


def variant_array(v: Column, key: str | None = None) -> Column:
    """Elements of a JSON array (NULL when the value is not an array)."""
    return F.try_variant_get(v, _path(key), "array<variant>")


def _vget(v: Column, key: str) -> Column:
    path = "$['" + key.replace("'", "\\'") + "']"
    return F.try_variant_get(v, path, "variant")


def _strip(s: Column) -> Column:
    return F.regexp_replace(s, r"^[\s\x0b\x1c-\x1f\u0085 ]+|[\s\x0b\x1c-\x1f\u0085 ]+$", "")


# --------------------------------------------------------------------------- N1

def _identity_raw_keys(mapping: dict[str, Any]) -> list[str]:
    return [raw for raw, norm in mapping.get("common_fields_map", {}).items() if norm in AM.IDENTITY_FIELDS]


# JSON texts of values that count as missing when they are no strings: 0, 0.0, -0, 0e5, false, [], {}.
_EMPTY_VALUE = r"^(-?0+(\.0*)?([eE][+-]?\d+)?|false|\[\s*\]|\{\s*\})$"


def explode_records(payloads: DataFrame, body: str = "body", mapping: dict[str, Any] | None = None,
                    keep_empty: bool = False) -> DataFrame:
    """One row per candidate record (``record`` = the record's JSON object text).

    Accepted shapes: array of records; object holding the list or a single
    object under the first of ``records, data, items, payload,
    metrics_records`` that is a list or object; otherwise the object itself.
    Non-object list items are dropped. ``record_pos`` is the position in the
    list. Unparseable bodies give one row with ``parse_error = true``. Payloads
    without any record object give none, or with ``keep_empty`` one row whose
    ``record`` is NULL (request accounting counts them). ``weak_identity``: every
    identity field is missing, null, an empty text, zero, false or an empty list
    or object.
    """
    allow_duplicate_json_keys(payloads.sparkSession)
    keep = [c for c in payloads.columns if c != body]
    # steps of their own: a column that several expressions of the next step use is computed once
    payloads = payloads.select(*keep, F.col(body).alias("_b"), F.try_parse_json(F.col(body)).alias("_v"))
    b, v = F.col("_b"), F.col("_v")
    sel = None
    for k in AM.RECORD_KEYS:
        arr = variant_array(v, k)
        val = F.struct(F.lit(k).alias("k"), arr.alias("a"))
        cond = arr.isNotNull() | is_object(v, k)
        sel = F.when(cond, val) if sel is None else sel.when(cond, val)
    payloads = payloads.select(*keep, "_b", v.isNull().alias("parse_error"), is_object(v).alias("_top"),
                               variant_array(v).alias("_arr"), F.when(is_object(v), sel).alias("_sel"))
    top_obj, top_arr, chosen = F.col("_top"), F.col("_arr"), F.col("_sel")
    payloads = payloads.select("*", F.when(chosen["k"].isNotNull(), F.element_at(F.from_json(b, REC_SCHEMA), chosen["k"])).alias("_raw"))
    raw = F.col("_raw")
    payloads = payloads.select(
        *keep, "parse_error", F.when(top_arr.isNotNull(), b).when(chosen["a"].isNotNull(), raw).alias("_list"),
        F.coalesce(top_arr, chosen["a"]).alias("_items"),
        F.when(chosen["k"].isNotNull() & chosen["a"].isNull(), raw).when(top_obj & chosen["k"].isNull(), b).alias("_single"))
    list_text, list_var, single = F.col("_list"), F.col("_items"), F.col("_single")
    # element text (key order kept) from the JSON text, element type from the parsed variant
    elems = F.arrays_zip(
        F.from_json(list_text, "array<string>").alias("txt"),
        F.transform(list_var, lambda x: F.when(is_object(x), F.lit("OBJECT")).otherwise(F.lit("OTHER"))).alias("typ"),
    )
    cand = (F.when(list_text.isNotNull(), elems)
            .when(single.isNotNull(),
                  F.array(F.struct(single.alias("txt"), F.lit("OBJECT").alias("typ"))))
            .otherwise(F.array().cast("array<struct<txt:string,typ:string>>")))
    # request-level counts, computed on the payload row before the explode: all records
    # of a request come from this one row, so routing needs no shuffle by request
    id_keys = _identity_raw_keys(AM.load_mapping() if mapping is None else mapping)

    def weak_elem(e):
        cond = None
        for k in id_keys:
            text = F.element_at(e["m"], k)
            # the record is only looked at again where the text could be that of an empty value
            other = F.when(F.coalesce(text.rlike(_EMPTY_VALUE), F.lit(False)),
                           _jtype(_vget(F.try_parse_json(e["txt"]), k)) != "STRING")
            t = (F.coalesce(text, F.lit("")) == "") | F.coalesce(other, F.lit(False))
            cond = t if cond is None else (cond & t)
        return cond if cond is not None else F.lit(True)

    # each record object is parsed to its map once, in its own projection (kept apart
    # from the two uses below so the map is not computed twice)
    parsed = payloads.select(*keep, "parse_error", F.transform(cand, lambda e: F.struct(
        e["txt"].alias("txt"), e["typ"].alias("typ"),
        F.when(e["typ"] == "OBJECT", json_map(e["txt"])).alias("m"))).alias("_c"))
    parsed = parsed.withColumn("_c", F.transform("_c", lambda e: F.struct(
        e["txt"].alias("txt"), e["typ"].alias("typ"), e["m"].alias("m"),
        F.when(e["typ"] == "OBJECT", weak_elem(e)).alias("weak"))))
    objs = F.filter(F.col("_c"), lambda e: e["typ"] == "OBJECT")
    x = parsed.select(*keep, "parse_error",
                      F.size(objs).alias("req_records"),
                      F.size(F.filter(objs, lambda e: e["weak"])).alias("req_weak_records"),
                      F.posexplode_outer("_c").alias("record_pos", "_e"))
    is_record = F.coalesce(F.col("_e.typ") == "OBJECT", F.lit(False))
    only = (F.col("req_records") == 0) & (F.coalesce("record_pos", F.lit(0)) == 0) & F.lit(keep_empty)
    x = x.where(F.col("parse_error") | is_record | only)
    # one condition on a column of its own, so that the record is not parsed again for each use
    x = x.withColumn("_is", ~F.col("parse_error") & is_record)
    return x.select(
        *keep, "parse_error", F.when(F.col("parse_error") | F.col("_is"), F.col("record_pos")).alias("record_pos"),
        "req_records", "req_weak_records",
        F.when(F.col("_is"), F.col("_e.txt")).alias("record"),
        F.when(F.col("_is"), F.col("_e.m")).alias("record_map"),
        F.when(F.col("_is"), F.col("_e.weak")).alias("weak_identity"))


# --------------------------------------------------------------------------- N2..N7

def _metric_pairs(rec_map: Column, rec_v: Column, prefixes) -> Column:
    out = None
    for k in AM.METRIC_KEYS:
        text = F.element_at(rec_map, k)
        is_obj = text.startswith("{") & is_object(rec_v, k)  # of most keys the text says that they are none
        val = json_map(text)
        out = F.when(is_obj, val) if out is None else out.when(is_obj, val)
    fallback = F.map_filter(rec_map, lambda k, _v: _starts_any(k, prefixes))
    return out.otherwise(fallback)


def _starts_any(k: Column, prefixes) -> Column:
    cond = None
    for p in prefixes:
        t = k.startswith(p)
        cond = t if cond is None else (cond | t)
    return cond if cond is not None else F.lit(False)


def _explicit_class(rec_map: Column, rec_v: Column) -> Column:
    out = None
    for k in AM.CLASS_KEYS:
        s = _strip(F.element_at(rec_map, k))
        ok = (F.coalesce(F.length(s), F.lit(0)) > 0) & (_jtype(_vget(rec_v, k)) == "STRING")
        out = F.when(ok, F.upper(s)) if out is None else out.when(ok, F.upper(s))
    return out


def _voted_class(pairs: Column, prefix_map: dict[str, str]) -> Column:
    """Majority class of the metric keys by first matching prefix; tie -> class seen first."""
    def cls_of(k):
        e = None
        for p, c in prefix_map.items():
            e = F.when(k.startswith(p), F.lit(c)) if e is None else e.when(k.startswith(p), F.lit(c))
        return e if e is not None else F.lit(None).cast("string")

    init = F.struct(F.lit(None).cast("string").alias("cls"), F.lit(0).alias("n"))

    def most(seen):
        def step(acc, c):
            n = F.size(F.filter(seen, lambda x: x == c))
            return F.when(n > acc["n"], F.struct(c.alias("cls"), n.alias("n"))).otherwise(acc)
        return F.aggregate(F.array_distinct(seen), init, step, lambda acc: acc["cls"])

    return bound(F.filter(F.transform(F.map_keys(pairs), cls_of), lambda x: x.isNotNull()), most)


def normalize(payloads: DataFrame, mapping: dict[str, Any] | None = None, body: str = "body",
              keep_empty: bool = False) -> DataFrame:
    """Payload rows -> one normalised row per record (``keep_empty``: see ``explode_records``).

    Output columns: request_id, received_at (ISO text, UTC, 'Z'; texts that are
    no time stay as they are), the other payload columns, record_pos, weak_identity, parse_error, source, datasource, class_name,
    target_table, one column per common field (text), ``metrics`` (mapped
    name -> text) and ``extra_metrics`` (raw name -> text, unmapped pairs).
    """
    m = AM.load_mapping() if mapping is None else mapping
    prefix_map = m.get("class_prefix_map", {})
    prefixes = tuple(prefix_map.keys()) or AM.DEFAULT_PREFIXES
    recs = explode_records(payloads, body, m, keep_empty)
    rec_v = F.try_parse_json(F.col("record"))
    r = recs.withColumnRenamed("record_map", "_m").select("*", rec_v.alias("_v"))
    pairs = _metric_pairs(F.col("_m"), F.col("_v"), prefixes)
    r = r.withColumn("_pairs", pairs)
    cls = F.coalesce(_explicit_class(F.col("_m"), F.col("_v")), _voted_class(F.col("_pairs"), prefix_map),
                     F.lit(AM.UNKNOWN_CLASS))
    # the class comes out of a generator of one row: a filter on it (a table's rows) stays above and isn't taken apart into
    # the JSON expressions that it is made of, which would parse each record again for each of them
    r = r.select("*", F.explode(F.array(F.when(~F.col("parse_error"), cls))).alias("class_name"))
    metric_maps = F.create_map(*[x for c, mm in m.get("metric_map", {}).items()
                                 for x in (F.lit(c), _lit_map(mm))]) if m.get("metric_map") else None
    cm = F.element_at(metric_maps, F.col("class_name")) if metric_maps is not None else F.lit(None)
    r = r.withColumn("_cm", cm)
    mapped = F.transform_keys(F.map_filter(F.col("_pairs"), lambda k, _v: F.coalesce(F.map_contains_key(F.col("_cm"), k), F.lit(False))),
                              lambda k, _v: F.element_at(F.col("_cm"), k))
    extra = F.map_filter(F.col("_pairs"), lambda k, _v: ~F.coalesce(F.map_contains_key(F.col("_cm"), k), F.lit(False)))
    ds = None
    for k in AM.DATASOURCE_KEYS:
        present = F.map_contains_key(F.col("_m"), k)
        ds = F.when(present, F.element_at(F.col("_m"), k)) if ds is None else ds.when(present, F.element_at(F.col("_m"), k))
    ds = ds.otherwise(F.lit(m.get("datasource", "SCOPE")))
    common = [F.element_at(F.col("_m"), raw).alias(norm)
              for raw, norm in dict(m.get("common_fields_map", {})).items()]
    tables = AM.class_tables(m)
    keep = [c for c in payloads.columns if c not in (body, "received_at")]
    received = F.col("received_at")
    return r.select(
        *keep,
        (iso_utc(received) if dict(payloads.dtypes).get("received_at", "string") != "string"
         else F.coalesce(iso_utc(utc_time(received)), received)).alias("received_at"),
        "record_pos", "parse_error", "req_records", "req_weak_records", "weak_identity",
        F.lit(AM.SOURCE_NAME).alias("source"),
        ds.alias("datasource"),
        "class_name",
        (F.element_at(_lit_map(tables), F.col("class_name")) if tables else F.lit(None).cast("string")).alias("target_table"),
        *common,
        F.when(~F.col("parse_error"), mapped).alias("metrics"),
        F.when(~F.col("parse_error"), extra).alias("extra_metrics"),
    )


# --------------------------------------------------------------------------- N9, N10

def to_table_rows(norm: DataFrame, table: str, mapping: dict[str, Any] | None = None, keep=()) -> DataFrame:
    """Rows of one agent table, projected onto the table's stable column superset.

    Missing values are NULL, an empty ``extra_metrics`` stays an empty map;
    numeric metric columns are ``try_cast`` to double, ``timestamp_utc_s`` to
    bigint, ``received_at`` to a UTC timestamp (NULL where it is no time).
    """
    m = AM.load_mapping() if mapping is None else mapping
    schema = AM.table_schemas(m).get(table)
    if schema is None:
        raise KeyError(f"table {table!r} is not in the mapping; use discover_columns")
    common = set(m.get("common_fields_map", {}).values())
    rows = norm.where(F.col("target_table") == F.lit(table))
    out = [F.col(c) for c in keep]
    for c in schema:
        if c == "timestamp_utc_s":
            e = F.col(c).try_cast("double").try_cast("bigint")
        elif c in common:
            e = F.col(c)
        elif c == "received_at":
            e = utc_time(F.col(c))
        elif c in AM.META_COLUMNS:
            e = F.col(c)
        elif c == "extra_metrics":
            e = F.coalesce(F.col(c), F.create_map().cast("map<string,string>"))
        elif c in AM.TEXT_METRIC_COLUMNS:
            e = F.element_at(F.col("metrics"), c)
        else:
            e = F.element_at(F.col("metrics"), c).try_cast("double")
        out.append(e.alias(c))
    return rows.select(*out)


def unmapped_rows(norm: DataFrame, mapping: dict[str, Any] | None = None) -> DataFrame:
    """Records whose class has no target table (unknown classes): kept, not lost.

    Common fields as columns, metrics / extra metrics as maps, plus the meta
    columns, so a later mapping can re-process them."""
    m = AM.load_mapping() if mapping is None else mapping
    common = list(dict.fromkeys(m.get("common_fields_map", {}).values()))
    return norm.where(F.col("target_table").isNull() & ~F.col("parse_error")).select(
        "request_id", "record_pos", *common, "class_name", "datasource", "source", "received_at",
        "raw_payload_ref", "metrics", "extra_metrics")


def discover_columns(norm: DataFrame, table: str) -> DataFrame:
    """Columns for a table absent from the mapping: union of common and metric
    keys in first-seen order, then meta columns and extra_metrics."""
    rows = norm.where(F.col("target_table") == F.lit(table))
    commons = [c for c in AM.load_mapping()["common_fields_map"].values()]
    keys = F.concat(
        F.filter(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in commons]), lambda x: x.isNotNull()),
        F.map_keys(F.col("metrics")))
    seen = rows.select("request_id", "record_pos", F.posexplode(keys).alias("kpos", "column"))
    first = seen.groupBy("column").agg(F.min(F.struct("request_id", "record_pos", "kpos")).alias("first"))
    meta = [(c, 10**6 + i) for i, c in enumerate(list(AM.META_COLUMNS) + list(AM.JSON_COLUMNS))]
    extra = norm.sparkSession.createDataFrame(meta, "column string, ordinal int")
    found = first.select("column", F.lit(0).alias("ordinal"), "first")
    return (found.unionByName(extra.withColumn("first", F.lit(None).cast(found.schema["first"].dataType)))
            .groupBy("column").agg(F.min("ordinal").alias("ordinal"), F.min("first").alias("first"))
            .orderBy("ordinal", "first").select("column"))


# --------------------------------------------------------------------------- N11..N13

def is_weak(norm_cols=AM.IDENTITY_FIELDS) -> Column:
    """Weak identity: every identity field is missing, NULL or empty."""
    cond = None
    for f in norm_cols:
        t = F.coalesce(F.col(f), F.lit("")) == ""
        cond = t if cond is None else (cond & t)
    return cond


def route(norm: DataFrame, strict: bool, identity: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted records, quarantined requests).

    strict: a request with any weak record is rejected whole (reason
    ``strict_validation_failed_missing_identity``); lenient: such a request
    is quarantined once (``weak_identity_non_strict``) and its records are
    still accepted. Unparseable payloads are quarantined as
    ``normalization_exception``.

    With the default identity check the per-request counts come from the
    payload row (``normalize`` adds them before exploding), so accepted
    records are routed without any shuffle; only the (few) quarantined
    requests are grouped. A custom ``identity`` column is evaluated per record
    and gathered per request with a window.
    """
    if identity is None and "req_weak_records" in norm.columns:
        n = norm.withColumn("_req_weak", (F.col("req_weak_records") > 0).cast("int")) \
            .withColumn("_req_weak_n", F.col("req_weak_records")).withColumn("_req_n", F.col("req_records"))
    else:
        weak = (~identity) if identity is not None else (
            F.col("weak_identity") if "weak_identity" in norm.columns else is_weak())
        w = Window.partitionBy("request_id")
        n = norm.withColumn("_weak", F.coalesce(weak, F.lit(True)) & ~F.col("parse_error")) \
            .withColumn("_req_weak", F.max(F.col("_weak").cast("int")).over(w)) \
            .withColumn("_req_weak_n", F.sum(F.col("_weak").cast("int")).over(w)) \
            .withColumn("_req_n", F.count_if(~F.col("parse_error")).over(w)) \
            .drop("_weak")
    ok = ~F.col("parse_error") & ((F.col("_req_weak") == 0) | F.lit(not strict))
    accepted = n.where(ok).drop("_req_weak", "_req_weak_n", "_req_n")
    reason = (F.when(F.col("parse_error"), F.lit("normalization_exception"))
              .when(F.col("_req_weak") == 1, F.lit("strict_validation_failed_missing_identity" if strict
                                                   else "weak_identity_non_strict")))
    q = (n.where(F.col("parse_error") | (F.col("_req_weak") == 1))
         .groupBy("request_id").agg(F.first(reason, ignorenulls=True).alias("reason"),
                                    F.max("_req_weak_n").alias("weak_record_count"),
                                    F.max("_req_n").alias("total_records")))
    return accepted, q


def request_summary(norm: DataFrame, strict: bool) -> DataFrame:
    """Per request: record_count, weak_record_count, accepted, quarantined.

    Normalise with ``keep_empty``, else requests without records are missing."""
    is_record = ~F.col("parse_error") & F.col("record_pos").isNotNull()
    weak = (F.col("weak_identity") if "weak_identity" in norm.columns else is_weak()) & is_record
    g = norm.groupBy("request_id").agg(
        F.count_if(is_record).alias("record_count"),
        F.count_if(weak).alias("weak_record_count"),
        F.max(F.col("parse_error").cast("int")).alias("_err"))
    has_weak = F.col("weak_record_count") > 0
    return g.select(
        "request_id", "record_count", "weak_record_count",
        (~(has_weak & F.lit(strict))).alias("accepted"),
        (has_weak | (F.col("_err") == 1)).alias("quarantined"),
    )
