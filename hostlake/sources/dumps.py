"""Monitoring-API response dumps (JSON lines) as DataFrames.

Host pages, host-macro pages and host-tag pages are separate dumps joined by
``hostid`` (left joins, missing lists become empty); item and template pages
are read with a fixed schema. The test binding writes such dumps from the
``customer`` table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .testbind import AGENTLESS_GROUP, NON_AGENTLESS_SEGMENT, host_ip

HOST_SCHEMA = ("hostid string, name string, description string, status string, proxy_hostid string, "
               "interfaces array<struct<ip:string,dns:string,port:string,type:string,main:string,"
               "available:string,error:string,useip:string>>, "
               "groups array<struct<groupid:string,name:string>>, "
               "parentTemplates array<struct<templateid:string,name:string>>")
MACRO_SCHEMA = "hostid string, macros array<struct<macro:string,value:string,type:string,description:string>>"
TAG_SCHEMA = "hostid string, tags array<struct<tag:string,value:string>>"
ITEM_SCHEMA = ("itemid string, hostid string, name string, key_ string, value_type string, units string, "
               "status string, templateid string, _page int, _pos int")
TEMPLATE_SCHEMA = ("templateid string, name string, host string, description string, "
                   "templategroups array<struct<name:string>>, parentTemplates array<struct<templateid:string,name:string>>")


def read_host_dump(spark: SparkSession, dump_dir: str) -> DataFrame:
    hosts = spark.read.schema(HOST_SCHEMA).json(f"{dump_dir}/hosts")
    macros = spark.read.schema(MACRO_SCHEMA).json(f"{dump_dir}/macros")
    tags = spark.read.schema(TAG_SCHEMA).json(f"{dump_dir}/tags")
    j = hosts.join(macros, "hostid", "left").join(tags, "hostid", "left")
    return j.withColumn("macros", F.coalesce("macros", F.array().cast(macros.schema["macros"].dataType))) \
        .withColumn("tags", F.coalesce("tags", F.array().cast(tags.schema["tags"].dataType)))


def read_item_dump(spark: SparkSession, dump_dir: str) -> DataFrame:
    return spark.read.schema(ITEM_SCHEMA).json(f"{dump_dir}/items")


def read_template_dump(spark: SparkSession, dump_dir: str) -> DataFrame:
    return spark.read.schema(TEMPLATE_SCHEMA).json(f"{dump_dir}/templates")


# --------------------------------------------------------------------------- test binding

def write_dumps_from_customer(spark: SparkSession, sf_dir: str, items: DataFrame, dump_dir: str) -> None:
    """Host / macro / tag / item / template dumps derived from ``customer`` and the item binding."""
    cu = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    ks = k.cast("string")
    main_if = F.struct(host_ip(k).alias("ip"), F.concat(F.lower("c_name"), F.lit(".example.local")).alias("dns"),
                       F.lit("10050").alias("port"), F.lit("1").alias("type"), F.lit("1").alias("main"),
                       F.lit("1").alias("available"), F.lit("").alias("error"), F.lit("1").alias("useip"))
    mgmt_if = F.struct(F.concat(F.lit("192.168.1."), F.pmod(k, F.lit(256)).cast("string")).alias("ip"),
                       F.concat(F.lit("mgmt-"), ks, F.lit(".example.local")).alias("dns"),
                       F.lit("161").alias("port"), F.lit("2").alias("type"), F.lit("0").alias("main"),
                       F.lit("2").alias("available"), F.lit("timeout").alias("error"), F.lit("0").alias("useip"))
    ifaces = F.when(F.pmod(k, F.lit(3)) == 0, F.array(main_if, mgmt_if)).otherwise(F.array(main_if))
    grp = lambda n: F.struct(F.lit(None).cast("string").alias("groupid"), n.alias("name"))
    groups = F.when(seg == NON_AGENTLESS_SEGMENT, F.array(grp(seg))).otherwise(F.array(grp(F.lit(AGENTLESS_GROUP)), grp(seg)))
    tmpl = F.array(F.struct(F.concat(F.lit("1000"), F.pmod(k, F.lit(4)).cast("string")).alias("templateid"),
                            F.when(F.pmod(k, F.lit(4)) == 3, F.lit("Windows by WinRM")).otherwise(F.lit("Linux by SSH")).alias("name")))
    hosts = cu.select(ks.alias("hostid"), F.col("c_name").alias("name"),
                      F.when(F.pmod(k, F.lit(5)) == 0, F.concat(F.lit("segment "), seg)).otherwise(F.lit("")).alias("description"),
                      F.when(F.col("c_acctbal") >= 0, F.lit("0")).otherwise(F.lit("1")).alias("status"),
                      F.when(F.pmod(F.col("c_nationkey"), F.lit(5)) == 0, F.lit("0"))
                      .otherwise(F.col("c_nationkey").cast("string")).alias("proxy_hostid"),
                      ifaces.alias("interfaces"), groups.alias("groups"), tmpl.alias("parentTemplates"))
    hosts.write.mode("overwrite").json(f"{dump_dir}/hosts")
    mac_type = "array<struct<macro:string,value:string,type:string,description:string>>"
    tag_type = "array<struct<tag:string,value:string>>"
    mac = F.array(F.struct(F.lit("{$SSH.USER}").alias("macro"), F.lit("root").alias("value"), F.lit("0").alias("type"),
                           F.lit("").alias("description")),
                  F.struct(F.lit("{$SSH.PASS}").alias("macro"), F.concat(F.lit("secret"), ks).alias("value"),
                           F.lit("1").alias("type"), F.lit("password").alias("description")))
    # every host has a macro page and a tag page; some of them hold an empty list
    cu.select(ks.alias("hostid"), F.when(F.pmod(k, F.lit(2)) == 0, mac).otherwise(F.array().cast(mac_type)).alias("macros")) \
        .write.mode("overwrite").json(f"{dump_dir}/macros")
    tag = F.array(F.struct(F.lit("segment").alias("tag"), seg.alias("value")))
    cu.select(ks.alias("hostid"), F.when(F.pmod(k, F.lit(4)) != 1, tag).otherwise(F.array().cast(tag_type)).alias("tags")) \
        .write.mode("overwrite").json(f"{dump_dir}/tags")
    # item pages: every item on page 0, and again (renamed) on page 1; the first copy wins
    raw = items.select("itemid", "hostid", "name", "key_", "value_type",
                       F.when(F.col("units") == "", F.lit(None)).otherwise(F.col("units")).alias("units"),
                       F.when(F.col("status") == "Enabled", F.lit("0")).otherwise(F.lit("1")).alias("status"),
                       "templateid")
    first = raw.withColumn("_page", F.lit(0)).withColumn("_pos", F.lit(0))
    again = raw.withColumn("name", F.concat(F.lit("dup "), F.col("name"))).withColumn("_page", F.lit(1)) \
        .withColumn("_pos", F.lit(0))
    first.unionByName(again).write.mode("overwrite").json(f"{dump_dir}/items")
    segs = cu.select(seg.alias("s")).distinct()
    segs.select(F.concat(F.lit("2"), F.lpad(F.abs(F.hash("s")).cast("string"), 10, "0")).alias("templateid"),
                F.concat(F.lit("Template "), F.col("s")).alias("name"), F.lower(F.col("s")).alias("host"),
                F.lit("").alias("description"),
                F.array(F.struct(F.lit("Templates/Segments").alias("name"))).alias("templategroups"),
                F.array(F.struct(F.lit("10001").alias("templateid"), F.lit("Linux by SSH").alias("name"))).alias("parentTemplates")) \
        .write.mode("overwrite").json(f"{dump_dir}/templates")
