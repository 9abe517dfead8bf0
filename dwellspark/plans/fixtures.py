"""The star tables and the event stream seen as stage reports, rosters and contacts.

Dimensions are joined on the left, so a missing one never drops a row and a
query only joins the tables its columns come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspark.operators.teams import contact_lookup
from dwellspark.plans.registry import cte
from dwellspark.session import SCAN_PARTITIONS, split_hot_keys


# Declared, so that no job has to look into the files first.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

# Tables of a session that asks for dealt scans, and columns that tell their rows apart.
_DEALT = {"lineitem": ("l_orderkey", "l_partkey", "l_suppkey"), "events": ("event_id",), "orders": ("o_orderkey",)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = _dimension(spark, sf_dir, name)
    number = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(number), *_DEALT[name]) if number and name in _DEALT else df


def _dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Order of the rows: by order and line; lines that repeat differ in the last six digits. A long holds
# order keys up to 900 thousand million.
_SEQ = (
    "(l_orderkey * 10 + l_linenumber) * 1000000 "
    "+ (l_partkey * 31 + l_suppkey * 17 + cast(round(l_extendedprice * 100) as bigint)) % 1000000"
)
_LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

# column -> (tables it needs besides lineitem, expression)
_STAGE = {
    "lead_id": ("", "cast(l_orderkey as string)"),
    "deal_id": ("orders", "cast(o_custkey as string)"),
    "inn": ("orders", "lpad(cast(o_custkey as string), 10, '0')"),
    "report_date": ("", "cast(l_shipdate as date)"),
    "work_start_date": ("orders", "cast(o_orderdate as date)"),
    "deal_created_date": ("orders", "cast(o_orderdate as date)"),
    "product_group": ("part", "p_type"),
    "product": ("part", "p_brand"),
    "current_status": ("", "concat(l_returnflag, l_linestatus)"),
    "deal_stage": ("orders", "o_orderpriority"),
    "days_on_stage": ("", "l_quantity"),
    "days_since_deal": ("orders", "cast(datediff(l_shipdate, o_orderdate) as double)"),
    "tb": ("region", "r_name"),
    "km": ("supplier", "s_name"),
    "vks": ("nation", "n_name"),
    "client": ("customer", "c_name"),
    "sales_method": ("customer", "c_mktsegment"),
    "label": ("part", "p_name"),
    "change_conditions": ("", "l_linenumber % 2"),
    "data_entry": ("", "l_linenumber % 3"),
    "efs_flag": ("orders", "case when o_orderstatus = 'P' then 0 else 1 end"),
    "seq": ("", _SEQ),
    "line_key": (
        "",
        "concat_ws('-', " + ", ".join(f"cast({c} as string)" for c in _LINE) + ")",
    ),
}
# table -> (join condition, tables that have to come first)
_JOINS = {
    "orders": ("l_orderkey = o_orderkey", ()),
    "part": ("l_partkey = p_partkey", ()),
    "supplier": ("l_suppkey = s_suppkey", ()),
    "customer": ("o_custkey = c_custkey", ("orders",)),
    "nation": ("c_nationkey = n_nationkey", ("orders", "customer")),
    "region": ("n_regionkey = r_regionkey", ("orders", "customer", "nation")),
}
# Tables that order lines meet by a key of their own; the rest hang on the orders.
_OF_LINES = ("part", "supplier")
# Times of which every column uses the day.
_DAYS = ("l_shipdate", "o_orderdate")


def _by_day(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("date") for c in _DAYS if c in df.columns})


def stage_reports(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One order line as one dated status row; only the tables of `columns` are joined.

    What an exchange writes stays on disk until the query ends. Lines therefore carry their finished
    columns, orders meet their customers before they meet lines, and lines meet orders last and by the
    lead: the rows leave that join dealt by lead, and records per lead need no exchange of wide rows. A
    lead with very many rows is split by the join; only then do its records pass exchanges again.
    """
    split_hot_keys(spark)
    wanted = columns or tuple(_STAGE)
    need: set[str] = set()
    for c in wanted:
        source = _STAGE[c][0]
        if source:
            need |= {source, *_JOINS[source][1]}
    # These two are a key or a day of the line, which the joins carry anyway.
    ready = [c for c in wanted if not _STAGE[c][0] and c not in ("lead_id", "report_date")]
    lines = _by_day(table(spark, sf_dir, "lineitem")).selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", *[f"{_STAGE[c][1]} AS {c}" for c in ready]
    )
    for name in _OF_LINES:
        if name in need:
            lines = lines.join(_dimension(spark, sf_dir, name), F.expr(_JOINS[name][0]), "left")
    if "orders" in need:
        orders = _by_day(_dimension(spark, sf_dir, "orders"))
        for name, (on, _) in _JOINS.items():
            if name in need and name not in ("orders", *_OF_LINES):
                orders = orders.join(_dimension(spark, sf_dir, name), F.expr(on), "left")
        lead = _STAGE["lead_id"][1]
        on = f"{lead} = {lead.replace('l_orderkey', 'o_orderkey')}" if "lead_id" in wanted else _JOINS["orders"][0]
        lines = lines.join(orders, F.expr(on), "left")
    return lines.select(*[F.col(c) if c in ready else F.expr(_STAGE[c][1]).alias(c) for c in wanted])


_EVENT = {
    "lead_id": "cast(user_id as string)",
    "deal_id": "case when event_id % 3 <> 0 then cast(user_id % 50 as string) end",
    "inn": "concat('77', lpad(cast(user_id as string), 8, '0'))",
    "report_date": "cast(ts as date)",
    "work_start_date": "date_add(date'2023-12-01', cast(user_id % 20 as int))",
    "deal_created_date": "case when event_id % 3 <> 0 then date_add(date'2023-12-15', cast(user_id % 10 as int)) end",
    "product_group": "'events'",
    "product": "event_type",
    "current_status": "event_type",
    "deal_stage": "case event_id % 5 when 0 then '-' when 1 then 'nan' else concat('STEP_', cast(event_id % 3 as string)) end",
    "days_on_stage": "case when event_id % 17 <> 0 then value end",
    "days_since_deal": "cast(event_id % 40 as double)",
    "tb": "cast(user_id % 5 as string)",
    "km": "case when event_id % 4 <> 0 then concat('KM_', cast(user_id % 7 as string)) end",
    "vks": "case when event_id % 6 = 0 then '-' else concat('VKS_', cast(user_id % 3 as string)) end",
    "client": "concat('Общество с ограниченной ответственностью \"C', cast(user_id as string), '\"')",
    "label": "props",
    "sales_method": "case when event_id % 2 <> 0 then concat('M', cast(event_id % 4 as string)) end",
    "change_conditions": "cast(event_id % 2 as int)",
    "efs_flag": "case when event_id % 10 = 0 then 0 else 1 end",
    "seq": "event_id",
}


def event_reports(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One event as one status row: many rows per lead, status and date, with gaps."""
    wanted = columns or tuple(_EVENT)
    return table(spark, sf_dir, "events").select(*[F.expr(_EVENT[c]).alias(c) for c in wanted])


_TEAM = {
    "lead_id": "cast(l_orderkey as string)",
    "deal_id": "cast(o_custkey as string)",
    "report_date": "cast(l_shipdate as date)",
    "team_added_date": "case when l_partkey % 4 <> 0 then cast(o_orderdate as date) end",
    "member_tab_number": "cast(l_suppkey as string)",
    "member": "s_name",
    "role": "p_name",
    "is_leader": "case when l_linenumber % 2 = 1 then 'Да' else 'Нет' end",
    "tb": "r_name",
    "team_type": "case l_linenumber % 3 when 0 then '1' when 1 then '2.0' else '-' end",
    "seq": _SEQ,
}


def team_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as roster rows."""
    df = table(spark, sf_dir, "lineitem")
    for name, (on, _) in _JOINS.items():
        df = df.join(_dimension(spark, sf_dir, name), F.expr(on), "left")
    return df.select(*[F.expr(e).alias(c) for c, e in _TEAM.items()])


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as the contact directory; some have no second address."""
    raw = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("tab_number"),
        F.concat(F.lower("s_name"), F.lit("@alpha.test")).alias("email_alpha"),
        F.expr("case when s_suppkey % 3 <> 0 then concat(lower(s_name), '@sigma.test') else '' end").alias("email_sigma"),
        F.col("s_suppkey").alias("seq"),
    )
    return contact_lookup(raw)


def _sql(expression: str) -> str:
    """The same expression for the checking engine."""
    out = expression.replace("cast(datediff(l_shipdate, o_orderdate) as double)",
                             "cast(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) as double)")
    out = out.replace("date_add(date'2023-12-01', cast(user_id % 20 as int))", "date '2023-12-01' + cast(user_id % 20 as int)")
    out = out.replace("date_add(date'2023-12-15', cast(user_id % 10 as int))", "date '2023-12-15' + cast(user_id % 10 as int)")
    return out.replace("as string)", "as varchar)")


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{_sql(e)} AS {c}" for c, e in columns.items())


_STAR = "lineitem " + " ".join(f"LEFT JOIN {t} ON {on}" for t, (on, _) in _JOINS.items())

cte("sr", f"SELECT {_select({c: e for c, (_, e) in _STAGE.items()})} FROM {_STAR}")
cte("er", f"SELECT {_select(_EVENT)} FROM events")
cte("tm", f"SELECT {_select(_TEAM)} FROM {_STAR}")
cte(
    "ct",
    """SELECT lpad(cast(s_suppkey AS varchar), 8, '0') AS tab_number,
       lower(s_name) || '@alpha.test' AS email_alpha,
       CASE WHEN s_suppkey % 3 <> 0 THEN lower(s_name) || '@sigma.test' END AS email_sigma
       FROM supplier""",
)
