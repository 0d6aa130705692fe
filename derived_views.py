"""Source, target and dimension tables (fixed names of the mart) derived from the driver's TPC-H-style data.

The loads need a "source" with change timestamps, a "target" as it stood
before the run, a calendar and lookup dimensions. These views build them
from ``customer``, ``supplier``, ``orders`` and ``events`` with fixed
rules, so every load reads whole tables and grows with them. The id
arithmetic below only decides *which* rows already exist in a target or
carry a status (the prior state of the mart); no rule drops or caps rows
to make a query cheaper.

Fixed parameters shared with the DuckDB oracle SQL:
    window start  lo      = 2024-01-20 00:00:00
    run timestamp run_ts  = 2024-02-01 00:00:00
    source change time    = date '2024-01-01' + (id % 30) days
    target change time    = date '2024-01-01' + (id % 20) days
    day-number calendar key = days since 1990-01-01; day-of-month 13 missing
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.session import stored_table

LO = "2024-01-20 00:00:00"
RUN_TS = "2024-02-01 00:00:00"
CAL_BASE = "1990-01-01"


_TABLES: dict[tuple[str, str], DataFrame] = {}


def _application(spark: SparkSession) -> str:
    """Identity of the running Spark application (unlike id(), never reused by a later one)."""
    return spark.sparkContext.applicationId


def _session(spark: SparkSession) -> str:
    return f"{_application(spark)}:{spark._jsparkSession.sessionUUID()}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; the resolved relation is reused within a session so
    repeated views do not list files and read footers again."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (_session(spark), path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


_STORED: dict[tuple[str, str, str], tuple[str, StructType]] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived view that stands for a *stored* table (one with an aggregation
    in its definition): written once per application beside the checkpoints,
    then read like any table, so its aggregation is not re-run by every load
    that reads it."""
    key = (_application(spark), sf_dir.rstrip("/"), name)
    if key not in _STORED:
        df, path = stored_table(build(), keep=True)
        _STORED[key] = path, df.schema
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)


def _day(base: str, days: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), days.cast("int"))


def _changed(c: Column, modulo: int) -> Column:
    return _day("2024-01-01", c % modulo).cast("timestamp_ntz")


def up(c: Column) -> Column:
    """Change time of a source row."""
    return _changed(c, 30)


def upt(c: Column) -> Column:
    """Change time of a target row (always before the window)."""
    return _changed(c, 20)


def _floor_div(c: Column, d: int) -> Column:
    return F.floor(c / F.lit(d)).cast("bigint")


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def _value(t: str, name: str, key: Column, old: bool = False) -> Column:
    """A value of its own for every carried column and row (fixed by name and
    key; other ones in a target's prior state), so swapped columns show."""
    n = key.cast("bigint") + sum(map(ord, name)) * (3 if old else 1) if t != "string" else None
    made = {
        "string": lambda: F.concat(F.lit(f"{'old ' if old else ''}{name} "), key.cast("string")),
        "bigint": lambda: n,
        "double": lambda: n.cast("double") / 2,
        "date": lambda: F.date_add(F.lit("2001-01-01").cast("date"), (n % 4000).cast("int")),
    }[t]()
    return made.cast(t).alias(name)


# --------------------------------------------------------------------- company

def company_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        c.cast("bigint").alias("spls_cmpy_id"),
        F.when(c % 7 == 0, _null("bigint")).otherwise(_floor_div(c, 10)).alias("parnt_cmpy_id"),
        F.when(c % 5 == 0, _null("bigint")).otherwise(_floor_div(c, 100)).alias("ultmt_parnt_cmpy_id"),
        F.col("c_name").alias("cmpy_nm"),
        _value("string", "website_url_txt", c),
        F.col("c_mktsegment").alias("sic_cd"),
        _value("string", "naics_cd", c),
        _value("string", "naics_dscr", c),
        F.col("c_nationkey").cast("bigint").alias("emp_tot_cnt"),
        _value("bigint", "hrc_lvl_nmb", c),
        _value("string", "hrc_src_typ_cd", c),
        _value("string", "hrc_to_revw_ind", c),
        _value("string", "mltpl_parnt_ind", c),
        F.when(c % 11 == 5, F.lit("DEL")).otherwise(F.lit("NEW")).alias("row_stat_cd"),
        up(c).alias("row_updt_tms"),
    )


def company_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").filter(c % 3 != 0).select(
        (c + 1).cast("bigint").alias("spls_cmpy_ky"),
        c.cast("bigint").alias("spls_cmpy_id"),
        F.when(c % 7 == 0, F.lit(0)).when(c % 4 == 1, F.lit(-1)).otherwise(_floor_div(c, 10) + 1)
        .cast("bigint").alias("parnt_cmpy_ky"),
        F.when(c % 5 == 0, F.lit(0)).otherwise(_floor_div(c, 100) + 1).cast("bigint").alias("ultmt_parnt_cmpy_ky"),
        _value("string", "cmpy_nm", c, old=True),
        _value("string", "website_url_txt", c, old=True),
        _value("string", "sic_cd", c, old=True),
        _value("string", "naics_cd", c, old=True),
        _value("string", "naics_dscr", c, old=True),
        _value("bigint", "emp_tot_cnt", c, old=True),
        _value("bigint", "hrc_lvl_nmb", c, old=True),
        _value("string", "hrc_src_typ_cd", c, old=True),
        _value("string", "hrc_to_revw_ind", c, old=True),
        _value("string", "mltpl_parnt_ind", c, old=True),
        upt(c).alias("row_insrt_tms"),
        upt(c).alias("row_updt_tms"),
        F.lit("NEW").alias("row_stat_cd"),
    )


# ------------------------------------------------------------ shared dimensions

def site_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        (s + 1).cast("bigint").alias("spls_site_ky"),
        s.cast("bigint").alias("spls_site_id"),
        F.when(s % 10 == 3, F.lit("DEL")).when(s % 10 == 7, _null("string")).otherwise(F.lit("NEW"))
        .alias("row_stat_cd"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "calendar", lambda: _calendar(spark, sf_dir))


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = (
        table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("cld_dt"))
        .union(table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("cld_dt")))
        .filter(F.col("cld_dt").isNotNull() & (F.dayofmonth("cld_dt") != 13))
        .distinct()
    )
    return dates.select(
        "cld_dt",
        F.datediff(F.col("cld_dt"), F.lit(CAL_BASE).cast("date")).cast("bigint").alias("tm_ky"),
    )


# ----------------------------------------------------------------------- email

def _email_common(e: Column) -> list[Column]:
    sent = F.col("ts").cast("date")
    return [
        (e + 1).cast("bigint").alias("eml_ky"),
        F.concat((F.lit(1) + e % 6).cast("string"), F.lit("F")).alias("src_cd"),
        sent.alias("sent_dt"),
    ]


def email_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    sent = F.col("ts").cast("date")
    return table(spark, sf_dir, "events").select(
        *_email_common(e),
        e.cast("bigint").alias("eml_id"),
        F.date_add(sent, (F.lit(1) + e % 5).cast("int")).alias("allctn_strt_dt"),
        F.date_add(sent, (F.lit(10) + e % 5).cast("int")).alias("allctn_end_dt"),
        F.when(e % 8 == 0, _null("date")).otherwise(F.date_sub(sent, (e % 9).cast("int"))).alias("last_ord_dt"),
        F.col("user_id").cast("bigint").alias("fsc_ytd_ordr_cnt"),
        _value("bigint", "pr_12_prds_ordr_cnt", e),
        F.col("value").alias("pr_3_prds_rvn_amt"),
        _value("double", "pr_12_prds_rvn_amt", e),
        F.col("event_type").alias("sls_rep_nm"),
        F.when(e % 13 == 6, F.lit("DEL")).otherwise(F.lit("NEW")).alias("row_stat_cd"),
        up(e).alias("row_updt_tms"),
    )


def email_tgt(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").filter(e % 3 != 0).select(
        (e + 1).cast("bigint").alias("eml_promo_ky"),
        *_email_common(e),
        _value("bigint", "sent_tm_ky", e, old=True),
        _value("bigint", "allctn_strt_tm_ky", e, old=True),
        _value("date", "allctn_strt_dt", e, old=True),
        _value("bigint", "allctn_end_tm_ky", e, old=True),
        _value("date", "allctn_end_dt", e, old=True),
        _value("string", "sls_rep_nm", e, old=True),
        _value("bigint", "last_ord_tm_ky", e, old=True),
        _value("date", "last_ord_dt", e, old=True),
        _value("bigint", "fsc_ytd_ord_cnt", e, old=True),
        _value("bigint", "pr_12_prds_ord_cnt", e, old=True),
        _value("double", "pr_3_prds_rvn_amt", e, old=True),
        _value("double", "pr_12_prds_rvn_amt", e, old=True),
        upt(e).alias("row_insrt_tms"),
        upt(e).alias("row_updt_tms"),
        F.lit("NEW").alias("row_stat_cd"),
    )


# ---------------------------------------------------------------------- direct

def _promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` by the natural key of a promotion, with the columns the others of
    :func:`direct_raw` are made of (in the order in which those decide a tie)."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("bigint").alias("spls_prsn_id"),
        F.concat(F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus")).alias("src_cd"),
        F.col("o_orderdate").cast("date").alias("promo_dt"),
        "o_orderpriority",
        "o_totalprice",
    )


def _direct_columns(promotions: DataFrame) -> DataFrame:
    o, promo = F.col("o_orderkey"), F.col("promo_dt")
    return promotions.select(
        "o_orderkey",
        "spls_prsn_id",
        "src_cd",
        "promo_dt",
        F.when(o % 9 == 0, _null("bigint")).otherwise(o % 150).cast("bigint").alias("spls_site_id"),
        F.date_add(promo, (o % 4).cast("int")).alias("drop_dt"),
        F.date_add(promo, 7).alias("allctn_strt_dt"),
        F.date_add(promo, 21).alias("allctn_end_dt"),
        F.when(o % 6 == 0, _null("date")).otherwise(F.date_sub(promo, (o % 30).cast("int"))).alias("last_ord_dt"),
        F.col("o_orderpriority").alias("promo_typ_cd"),
        _value("string", "pdt_prmry_ctgry_nm", o),
        _value("bigint", "fsc_ytd_ordr_cnt", o),
        _value("bigint", "pr_12_prds_ordr_cnt", o),
        F.col("o_totalprice").alias("pr_3_prds_rvn_amt"),
        _value("double", "pr_12_prds_rvn_amt", o),
        _value("string", "sls_rep_nm", o),
        F.when(o % 17 == 4, F.lit("DEL")).otherwise(F.lit("NEW")).alias("row_stat_cd"),
        up(o).alias("row_updt_tms"),
    )


def direct_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _direct_columns(_promotions(spark, sf_dir))


DIRECT_KEY = ["spls_prsn_id", "src_cd", "promo_dt"]


def direct_src(spark: SparkSession, sf_dir: str, keep_orderkey: bool = False) -> DataFrame:
    """``direct_raw`` with one row per natural key: the highest order key wins.

    The orders are compared and stored before the other columns are made of them."""
    from martloom.operators.guards import dedupe_newest

    out = _direct_columns(_stored(spark, sf_dir, "direct_src",
                                  lambda: dedupe_newest(_promotions(spark, sf_dir), DIRECT_KEY, ["o_orderkey"])))
    return out if keep_orderkey else out.drop("o_orderkey")


def direct_tgt(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    src = direct_src(spark, sf_dir, keep_orderkey=True).filter(o % 3 != 0)
    return src.select(
        (o + 1).cast("bigint").alias("drct_ml_promo_ky"),
        "src_cd",
        "spls_prsn_id",
        F.when(o % 2 == 0, F.lit(-1)).otherwise(F.coalesce(F.col("spls_site_id") + 1, F.lit(0)))
        .cast("bigint").alias("spls_site_ky"),
        "promo_dt",
        _value("bigint", "drop_tm_ky", o, old=True),
        _value("date", "drop_dt", o, old=True),
        _value("bigint", "allctn_strt_tm_ky", o, old=True),
        _value("date", "allctn_strt_dt", o, old=True),
        _value("bigint", "allctn_end_tm_ky", o, old=True),
        _value("date", "allctn_end_dt", o, old=True),
        _value("bigint", "last_ord_tm_ky", o, old=True),
        _value("date", "last_ord_dt", o, old=True),
        _value("string", "promo_typ_cd", o, old=True),
        _value("string", "pdt_prmry_ctgry_nm", o, old=True),
        _value("bigint", "fsc_ytd_ord_cnt", o, old=True),
        _value("bigint", "pr_12_prds_ord_cnt", o, old=True),
        _value("double", "pr_3_prds_rvn_amt", o, old=True),
        _value("double", "pr_12_prds_rvn_amt", o, old=True),
        _value("string", "sls_rep_nm", o, old=True),
        upt(o).alias("row_updt_tms"),
        upt(o).alias("row_insrt_tms"),
        F.lit("NEW").alias("row_stat_cd"),
    )


def direct_raw_with_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``direct_raw`` where some keys are NULL (person for order keys % 97 = 0,
    source code for % 89 = 0): input for the NULL-key guard."""
    o = F.col("o_orderkey")
    return direct_raw(spark, sf_dir).select(
        "o_orderkey",
        F.when(o % 97 == 0, _null("bigint")).otherwise(F.col("spls_prsn_id")).alias("spls_prsn_id"),
        F.when(o % 89 == 0, _null("string")).otherwise(F.col("src_cd")).alias("src_cd"),
        "promo_dt",
        "row_stat_cd",
        "row_updt_tms",
    )


# -------------------------------------------------------------------- taxonomy

def cust_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.when(s % 2 == 0, F.lit("SHIPTO")).otherwise(F.lit("SOLDTO")).alias("cust_lvl"),
        (s + 1).cast("bigint").alias("spls_site_ky"),
        F.col("s_nationkey").cast("bigint").alias("mstr_cust_ky"),
    )


def eml_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").filter(e % 4 != 0).select(
        e.cast("bigint").alias("eml_id"), (e + 1).cast("bigint").alias("eml_ky")
    )


def usr_eml(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    e = F.col("event_id")
    first = ev.select((e + 1).cast("bigint").alias("eml_ky"), F.col("user_id").cast("bigint").alias("oms_usr_ky"))
    second = ev.filter(e % 2 == 0).select(
        (e + 1).cast("bigint").alias("eml_ky"), (F.col("user_id") + 1000).cast("bigint").alias("oms_usr_ky")
    )
    return first.unionByName(second)


def usr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("bigint").alias("oms_usr_ky"),
        F.col("c_nationkey").cast("bigint").alias("mstr_cust_ky"),
    )


def txn_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "txn_src", lambda: _txn_src(spark, sf_dir))


def _txn_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = (
        direct_src(spark, sf_dir).select("src_cd")
        .union(email_src(spark, sf_dir).select("src_cd"))
        .union(spark.range(1).select(F.lit("ZZ").alias("src_cd")))
        .distinct()
    )
    code = F.col("src_cd")
    shift = F.ascii(code)
    return codes.select(
        code,
        F.substring(code, 1, 1).alias("pgm_cd"),
        F.concat(F.lit("Program "), F.substring(code, 1, 1)).alias("pgm_nm"),
        _value("string", "cmpgn_cd", code),
        _value("string", "cmpgn_nm", code),
        _value("string", "cmpgn_typ_nm", code),
        _value("string", "vrsn_cd", code),
        _value("string", "vrsn_desc", code),
        _value("string", "vrsn_frmt_nm", code),
        _value("string", "segmt_cd", code),
        _value("string", "segmt_nm", code),
        _value("string", "chnnl_cd", code),
        _value("string", "chnnl_nm", code),
        _value("string", "cst_per_piece_ind", code),
        _value("string", "test_cmpgn_ind", code),
        _day("1995-01-01", shift).alias("cmpgn_strt_dt"),
        _day("1995-06-01", shift).alias("cmpgn_end_dt"),
        _day("1995-03-01", shift).alias("drp_dt"),
        _value("string", "pdt_prmry_ctgry_nm", code),
        F.when(code == "2P", F.lit("DEL")).otherwise(F.lit("NEW")).alias("row_stat_cd"),
        F.when(code == "1O", F.lit("2024-01-05 00:00:00")).otherwise(F.lit("2024-01-25 00:00:00"))
        .cast("timestamp_ntz").alias("row_updt_tms"),
    )


def txn_tgt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "txn_tgt", lambda: _txn_tgt(spark, sf_dir))


def _txn_tgt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes ending in F plus '1O', numbered 1.. in code order (with the
    library's ranged key assignment, never a single-partition window)."""
    from martloom.operators.keys import assign_surrogate_keys

    src = txn_src(spark, sf_dir).filter(F.col("src_cd").endswith("F") | (F.col("src_cd") == "1O"))
    src = assign_surrogate_keys(src, ["src_cd"], "src_txnmy_ky", 0).keyed
    cols = [c for c in src.columns if c not in ("src_txnmy_ky", "pgm_nm", "row_stat_cd", "row_updt_tms")]
    return src.select(
        "src_txnmy_ky",
        *[F.col(c) if c == "src_cd" else F.concat(F.lit("old "), F.col(c)).alias(c)
          for c in cols if c not in ("cmpgn_strt_dt", "cmpgn_end_dt", "drp_dt", "pdt_prmry_ctgry_nm")],
        F.lit("old").alias("pgm_nm"),
        _value("bigint", "cmpgn_strt_tm_ky", F.ascii("src_cd"), old=True),
        "cmpgn_strt_dt",
        _value("bigint", "cmpgn_end_tm_ky", F.ascii("src_cd"), old=True),
        "cmpgn_end_dt",
        _value("bigint", "drp_tm_ky", F.ascii("src_cd"), old=True),
        "drp_dt",
        F.concat(F.lit("old "), F.col("pdt_prmry_ctgry_nm")).alias("pdt_prmry_ctgry_nm"),
        F.lit(0).cast("bigint").alias("promo_site_cnt"),
        F.lit(0).cast("bigint").alias("promo_usr_cnt"),
        F.lit(0).cast("bigint").alias("promo_mstr_cust_cnt"),
        F.lit(0).cast("bigint").alias("promo_eml_cnt"),
        F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("row_updt_tms"),
        F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("row_insrt_tms"),
        F.lit("NEW").alias("row_stat_cd"),
    )
