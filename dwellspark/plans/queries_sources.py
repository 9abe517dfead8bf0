"""Queries for loading, cleaning and writing."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dwellspark.functions.dates import parse_date
from dwellspark.functions.output import json_safe, sanitize
from dwellspark.functions.text import (
    client_name,
    id_token,
    is_empty,
    person_name,
    tab_number,
    tab_number_lines,
    text_id,
)
from dwellspark.operators.teams import contact_lookup, leaders_only, split_team, team_type_counts
from dwellspark.operators.tracking import add_durations
from dwellspark.plans.fixtures import event_reports, stage_reports, table, team_members
from dwellspark.plans.registry import cte, query
from dwellspark.session import ensure_checkpoint_dir
from dwellspark.sources.folders import load_folder
from dwellspark.sources.rejects import BROKEN_LINE, accepted, fault_counts, file_counts, with_faults
from dwellspark.sources.reports import load_reports, normalize_reports, project_required, with_category
from dwellspark.sources.rosters import load_team
from dwellspark.sources.sinks import partition_counts, read_csv, write_csv, write_split, write_table

LINE_HEADERS = {
    "lead_id": " L_ORDERKEY",
    "report_date": "l_shipdate",
    "current_status": "l_returnflag",
    "days_on_stage": "l_quantity",
}
EVENT_HEADERS = {
    "lead_id": "user_id",
    "report_date": "ts",
    "current_status": "event_type ",
    "days_on_stage": "value",
    "label": "props",
}
NEEDED = ("lead_id", "report_date", "current_status", "days_on_stage")


def _two_files(spark, sf):
    return load_reports(
        spark,
        [(f"{sf}/lineitem.parquet", LINE_HEADERS), (f"{sf}/events.parquet", EVENT_HEADERS)],
        required=NEEDED,
    )


@query(
    "q_load_reports",
    """SELECT source_file, current_status, count(*) AS report_rows, count(label) AS labelled,
       max(days_on_stage) AS max_days, min(cast(report_date AS date)) AS first_date
    FROM (SELECT 'lineitem.parquet' AS source_file, l_returnflag AS current_status, l_quantity AS days_on_stage,
                 l_shipdate AS report_date, NULL AS label FROM lineitem
          UNION ALL SELECT 'events.parquet', event_type, value, ts, props FROM events)
    GROUP BY source_file, current_status""",
)
def q_load_reports(spark, sf):
    return (
        normalize_reports(_two_files(spark, sf))
        .groupBy("source_file", "current_status")
        .agg(
            F.count(F.lit(1)).alias("report_rows"),
            F.count("label").alias("labelled"),
            F.max("days_on_stage").alias("max_days"),
            F.min("report_date").alias("first_date"),
        )
    )


MIXED_HEADERS = {
    "lead_id": ("ID", "lead number"),
    "report_date": "date",
    "current_status": ("Status", "state"),
    "days_on_stage": "days",
    "label": "note",
}
# How each third of the lines names, orders and types its columns.
_VARIANTS = (
    {"ID": "l_orderkey", "Date": "cast(l_shipdate as date)", "STATUS": "l_returnflag", "Days": "l_quantity", "note": "l_linestatus"},
    {"days ": "cast(cast(l_quantity as int) as string)", " date": "date_format(l_shipdate, 'dd.MM.yyyy')", "more": "l_tax",
     "state": "concat(' ', l_returnflag)", "Lead Number": "concat(l_orderkey, '.0')"},
    {"status": "l_returnflag", "note": "l_linestatus", "days": "cast(l_quantity as float)", "id": "cast(l_orderkey as double)",
     "DATE": "l_shipdate"},
)


def _mixed_folder(spark, sf, fmt):
    """Lines as files with three kinds of headers, one folder below the other."""
    path = _scratch(spark, f"mixed-{fmt}")
    line = table(spark, sf, "lineitem")
    for i, variant in enumerate(_VARIANTS):
        part = line.filter(F.col("l_linenumber") % 3 == i).select(*[F.expr(e).alias(c) for c, e in variant.items()])
        if fmt == "csv":
            write_csv(part, f"{path}/{i}/{'deep' if i else ''}")
        else:
            part.write.parquet(f"{path}/{i}/{'deep' if i else ''}")
    return path


_MIXED_SQL = """SELECT cast(l_orderkey AS varchar) AS lead_id, cast(l_shipdate AS date) AS report_date,
       l_returnflag AS current_status, l_quantity AS days_on_stage,
       CASE WHEN l_linenumber % 3 <> 1 THEN l_linestatus END AS label FROM lineitem"""


@query("q_load_mixed_headers", _MIXED_SQL)
def q_load_mixed_headers(spark, sf):
    """A folder of files with three headers and three sets of types, one scan for each."""
    rows = load_folder(spark, _mixed_folder(spark, sf, "parquet"), MIXED_HEADERS, required=NEEDED, pattern="*.parquet")
    return rows.select("lead_id", "report_date", "current_status", F.col("days_on_stage").cast("double"), "label")


@query("q_load_mixed_csv", _MIXED_SQL)
def q_load_mixed_csv(spark, sf):
    """The same as delimited text, where columns are found by the header of each file."""
    rows = load_folder(
        spark, _mixed_folder(spark, sf, "csv"), MIXED_HEADERS, "csv", required=NEEDED, pattern="*.csv", sep=";"
    )
    return rows.select("lead_id", "report_date", "current_status", "days_on_stage", "label")


_PARTS = {"early": "l_linenumber <= 2", "late": "l_linenumber > 2"}


def _checked_lines(spark, sf):
    """Lines as text with dates and numbers that do not exist, leads that are missing and lines that are
    cut, in two folders; loaded with their faults."""
    path = _scratch(spark, "faulty")
    turn = F.col("l_orderkey") % 11
    values = [
        F.when(turn == 1, "-").otherwise(F.col("l_orderkey").cast("string")),
        F.when(turn == 2, "31.02.1998").when(turn == 3, "").otherwise(F.date_format("l_shipdate", "dd.MM.yyyy")),
        F.when(turn == 4, "a week").when(turn == 3, "nan").otherwise(F.col("l_quantity").cast("string")),
        F.col("l_returnflag"),
    ]
    text = F.when(turn == 5, F.concat_ws(";", *values[:3])).otherwise(F.concat_ws(";", *values))
    out = []
    for part, where in _PARTS.items():
        # A line is one text, and its header the name of the only column.
        lines = table(spark, sf, "lineitem").filter(where).select(text.alias("lead;date;days;status"))
        lines.write.options(header=True, quote="", sep="\x01").csv(f"{path}/{part}")
        headers = {"lead_id": "lead", "report_date": "date", "days_on_stage": "days", "current_status": "status"}
        rows = load_folder(
            spark, f"{path}/{part}", headers, "csv", NEEDED, "*.csv", keep_corrupt=True, normalise=with_faults, sep=";"
        )
        out.append(rows.withColumn("part", F.lit(part)))
    return out[0].unionByName(out[1])


cte(
    "faulty",
    """SELECT *, l_orderkey % 11 AS turn, CASE WHEN l_linenumber <= 2 THEN 'early' ELSE 'late' END AS part FROM lineitem""",
)


@query(
    "q_fault_counts",
    """SELECT part, kind.col AS column, kind.reason AS reason, count(*) AS faults FROM faulty JOIN (VALUES
         (1, 'lead_id', 'no lead'), (2, 'report_date', 'unreadable date'), (4, 'days_on_stage', 'unreadable number'),
         (5, '_corrupt_record', 'line does not fit its header')) AS kind(turn, col, reason) ON faulty.turn = kind.turn
       GROUP BY part, kind.col, kind.reason""",
)
def q_fault_counts(spark, sf):
    """What could not be read, per source and reason."""
    return fault_counts(_checked_lines(spark, sf), ("part",))


@query(
    "q_load_log",
    """SELECT part, count(*) AS file_rows, count(*) FILTER (turn IN (1, 2, 4, 5)) AS faulty_rows FROM faulty GROUP BY part""",
)
def q_load_log(spark, sf):
    return file_counts(_checked_lines(spark, sf), ("part",))


@query(
    "q_accepted_rows",
    """SELECT CASE WHEN turn <> 1 THEN cast(l_orderkey AS varchar) END AS lead_id,
       CASE WHEN turn NOT IN (2, 3) THEN cast(l_shipdate AS date) END AS report_date,
       CASE WHEN turn NOT IN (3, 4) THEN l_quantity END AS days_on_stage, l_returnflag AS current_status
       FROM faulty WHERE turn <> 5""",
)
def q_accepted_rows(spark, sf):
    """Rows stay with nulls where a value was at fault; here lines that do not fit their header go."""
    kept = accepted(_checked_lines(spark, sf), [BROKEN_LINE])
    return kept.select("lead_id", "report_date", "days_on_stage", "current_status")


@query(
    "q_project_required",
    """SELECT l_orderkey AS lead_id, l_shipdate AS report_date, l_returnflag AS current_status,
       l_quantity AS days_on_stage FROM lineitem""",
)
def q_project_required(spark, sf):
    return project_required(table(spark, sf, "lineitem"), LINE_HEADERS, NEEDED)


cte(
    "dirty",
    """SELECT seq, report_date, lead_id, deal_id, inn, product_group, days_on_stage, data_entry, change_conditions FROM sr""",
)


def dirty_reports(spark, sf):
    """Report rows as text, with the faults that exports have."""
    df = stage_reports(
        spark, sf, "seq", "report_date", "lead_id", "deal_id", "inn", "product_group", "days_on_stage",
        "data_entry", "change_conditions",
    )
    turn = F.col("data_entry")
    serial = F.datediff("report_date", F.lit("1899-12-30").cast("date")).cast("string")
    days = F.col("days_on_stage").cast("int").cast("string")
    return df.select(
        "seq",
        F.when(turn == 0, F.date_format("report_date", "dd.MM.yyyy"))
        .when(turn == 1, F.date_format("report_date", "yyyy-MM-dd"))
        .otherwise(serial)
        .alias("report_date"),
        F.when(turn == 1, F.concat("lead_id", F.lit(".0"))).otherwise(F.col("lead_id")).alias("lead_id"),
        F.when(turn == 0, F.lit(" - ")).otherwise(F.col("deal_id")).alias("deal_id"),
        F.when(turn == 2, F.concat("inn", F.lit(".00"))).otherwise(F.col("inn")).alias("inn"),
        F.concat(F.lit(" \t"), "product_group", F.lit(" ")).alias("product_group"),
        F.when(turn == 0, F.concat(F.lit(" "), days)).when(turn == 1, F.lit("nan")).otherwise(days).alias("days_on_stage"),
        F.concat(F.col("change_conditions").cast("string"), F.lit(".0")).alias("change_conditions"),
    )


@query(
    "q_normalize_reports",
    """SELECT report_date, lead_id, CASE WHEN data_entry <> 0 THEN deal_id END AS deal_id, inn, product_group,
       CASE WHEN data_entry <> 1 THEN days_on_stage END AS days_on_stage, change_conditions FROM dirty""",
)
def q_normalize_reports(spark, sf):
    return normalize_reports(dirty_reports(spark, sf)).drop("seq")


@query(
    "q_source_category",
    """SELECT category, count(*) AS report_rows FROM (SELECT 'IN WORK' AS category FROM lineitem
       UNION ALL SELECT 'UNKNOWN' FROM events) GROUP BY category""",
)
def q_source_category(spark, sf):
    tagged = with_category(_two_files(spark, sf), [("customer", "FOR SALE"), ("line", "IN WORK")])
    return tagged.groupBy("category").agg(F.count(F.lit(1)).alias("report_rows"))


@query(
    "q_load_team",
    """SELECT lpad(cast(l_suppkey AS varchar), 8, '0') AS member_tab_number, 'lineitem.parquet' AS source_file,
       count(*) AS roster_rows, count(DISTINCT l_orderkey) AS leads FROM lineitem GROUP BY l_suppkey""",
)
def q_load_team(spark, sf):
    team = load_team(
        spark,
        [f"{sf}/lineitem.parquet"],
        headers={
            "lead_id": "L_OrderKey ",
            "member_tab_number": " l_suppkey",
            "member": "l_suppkey",
            "is_leader": "L_LINESTATUS",
            "team_type": "not there",
        },
    )
    return team.groupBy("member_tab_number", "source_file").agg(
        F.count(F.lit(1)).alias("roster_rows"), F.count_distinct("lead_id").alias("leads")
    )


@query(
    "q_team_leaders_only",
    """SELECT lead_id, member, role, report_date FROM tm WHERE is_leader = 'Да'""",
)
def q_team_leaders_only(spark, sf):
    return leaders_only(team_members(spark, sf)).select("lead_id", "member", "role", "report_date")


@query(
    "q_team_split",
    """SELECT CASE team_type WHEN '1' THEN 'lead' ELSE 'deal' END AS team, member, count(*) AS roster_rows
       FROM tm WHERE team_type <> '-' GROUP BY ALL""",
)
def q_team_split(spark, sf):
    lead, deal = split_team(team_members(spark, sf))
    both = lead.withColumn("team", F.lit("lead")).unionByName(deal.withColumn("team", F.lit("deal")))
    return both.groupBy("team", "member").agg(F.count(F.lit(1)).alias("roster_rows"))


@query(
    "q_team_type_counts",
    """SELECT CASE team_type WHEN '1' THEN 'lead' WHEN '2.0' THEN 'deal' ELSE 'unknown' END AS team,
       count(*) AS roster_rows FROM tm GROUP BY ALL""",
)
def q_team_type_counts(spark, sf):
    return team_type_counts(team_members(spark, sf))


@query(
    "q_contact_lookup",
    """SELECT lpad(cast(l_suppkey AS varchar), 8, '0') AS tab_number,
       arg_min('a' || l_partkey, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice))
         FILTER (WHERE l_linenumber % 3 <> 0) AS email_alpha,
       arg_min('s' || l_partkey, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice))
         FILTER (WHERE l_linenumber % 5 = 0) AS email_sigma
    FROM lineitem GROUP BY l_suppkey""",
)
def q_contact_lookup(spark, sf):
    line = table(spark, sf, "lineitem")
    directory = line.select(
        F.concat(F.lit(" 00"), F.col("l_suppkey").cast("string")).alias("tab_number"),
        F.expr("case when l_linenumber % 3 <> 0 then concat(' a', l_partkey) else ' ' end").alias("email_alpha"),
        F.expr("case when l_linenumber % 5 = 0 then concat('s', l_partkey) end").alias("email_sigma"),
        F.expr("struct(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)").alias("seq"),
    )
    return contact_lookup(directory)


def _scratch(spark, name):
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query("q_sink_csv", "SELECT lead_id, deal_id, report_date, tb, days_on_stage FROM sr")
def q_sink_csv(spark, sf):
    path = _scratch(spark, "csv")
    rows = stage_reports(spark, sf, "lead_id", "deal_id", "report_date", "tb", "days_on_stage")
    write_csv(rows, path, row_limit=20_000)
    return read_csv(spark, path, rows.schema)


@query("q_sink_csv_long_text", "SELECT doc_id, CASE WHEN text = '' THEN NULL ELSE text END AS text FROM documents")
def q_sink_csv_long_text(spark, sf):
    """Whole texts through a CSV file; line breaks inside quotes are read back."""
    path = _scratch(spark, "csv-text")
    write_csv(table(spark, sf, "documents").select("doc_id", "text"), path)
    return read_csv(spark, path, "doc_id long, text string")


@query(
    "q_json_nested_safe",
    """SELECT event_id, [CASE WHEN event_id % 9 IN (0, 1) THEN NULL ELSE value END, 1.5] AS list,
       CASE WHEN event_id % 9 IN (0, 1) THEN NULL ELSE value END AS inner_value FROM events""",
)
def q_json_nested_safe(spark, sf):
    """Numbers inside arrays and structs, written as JSON and read again."""
    turn = F.col("event_id") % 9
    value = F.when(turn == 0, F.lit(float("nan"))).when(turn == 1, F.lit(float("-inf"))).otherwise(F.col("value"))
    rows = table(spark, sf, "events").select(
        "event_id", F.array(value, F.lit(1.5)).alias("list"), F.array(F.struct(value.alias("x"))).alias("records")
    )
    path = _scratch(spark, "json")
    write_table(rows, path, "json")
    back = spark.read.schema(rows.schema).json(path)
    return back.select("event_id", "list", F.col("records")[0]["x"].alias("inner_value"))


@query(
    "q_partition_counts",
    "SELECT tb AS part, cast(count(*) AS bigint) AS out_rows FROM sr GROUP BY tb",
)
def q_partition_counts(spark, sf):
    path = _scratch(spark, "split")
    write_split(stage_reports(spark, sf, "lead_id", "tb"), path)
    return partition_counts(spark.read.parquet(path))


@query(
    "q_json_safe",
    """SELECT event_id, CASE WHEN event_id % 9 IN (0, 1) THEN NULL ELSE value END AS value FROM events""",
)
def q_json_safe(spark, sf):
    turn = F.col("event_id") % 9
    value = F.when(turn == 0, F.lit(float("nan"))).when(turn == 1, F.lit(float("-inf"))).otherwise(F.col("value"))
    return json_safe(table(spark, sf, "events").select("event_id", value.alias("value")))


@query(
    "q_sanitize_text",
    """SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE
       regexp_replace(chr(7) || text || chr(1), '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g') END AS text
       FROM documents""",
)
def q_sanitize_text(spark, sf):
    docs = table(spark, sf, "documents")
    text = F.when(F.col("doc_id") % 11 == 0, F.lit("NaT")).otherwise(
        F.concat(F.lit("\x07"), "text", F.lit("\x01"))
    )
    return sanitize(docs.select("doc_id", text.alias("text")))


# --- cleaning ---------------------------------------------------------------


@query(
    "q_parse_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 7 THEN NULL ELSE cast(o_orderdate AS date) END AS parsed
       FROM orders""",
)
def q_parse_dates(spark, sf):
    day = F.col("o_orderdate").cast("date")
    forms = [
        F.date_format(day, "dd.MM.yyyy"),
        F.date_format(day, "d.M.yyyy"),
        F.date_format(day, "dd.MM.yy"),
        F.date_format(day, "yyyy-MM-dd"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 10:20:30")),
        F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string"),
        F.concat(F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string"), F.lit(".75")),
    ]
    text = F.lit(" N/A ")
    for i, form in enumerate(forms):
        text = F.when(F.col("o_orderkey") % 8 == i, form).otherwise(text)
    return table(spark, sf, "orders").select("o_orderkey", parse_date(text).alias("parsed"))


@query(
    "q_empty_tokens",
    """SELECT p_partkey, p_partkey % 6 IN (0, 1, 2, 3) AS empty FROM part""",
)
def q_empty_tokens(spark, sf):
    turn = F.col("p_partkey") % 6
    value = (
        F.when(turn == 0, F.lit("  - "))
        .when(turn == 1, F.lit("NaN"))
        .when(turn == 2, F.lit(""))
        .when(turn == 4, F.lit("- x"))
        .when(turn == 5, F.col("p_name"))
    )
    return table(spark, sf, "part").select("p_partkey", is_empty(value).alias("empty"))


@query(
    "q_text_ids",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 5 THEN NULL WHEN 3 THEN '1' || lpad(cast(o_custkey AS varchar), 9, '0')
       WHEN 4 THEN cast(o_custkey AS varchar) || '.5' ELSE cast(o_custkey AS varchar) END AS client_id FROM orders""",
)
def q_text_ids(spark, sf):
    turn, key = F.col("o_orderkey") % 6, F.col("o_custkey").cast("string")
    nine = F.lpad(key, 9, "0")
    text = (
        F.when(turn == 0, key)
        .when(turn == 1, F.concat(key, F.lit(".00")))
        .when(turn == 2, F.concat(F.lit(" "), key, F.lit(" ")))
        .when(turn == 3, F.concat(F.lit("1."), nine, F.lit("E+9")))
        .when(turn == 4, F.concat(key, F.lit(".5")))
        .otherwise(F.lit("<NA>"))
    )
    return table(spark, sf, "orders").select("o_orderkey", text_id(text).alias("client_id"))


@query(
    "q_tab_number",
    """SELECT l_orderkey, l_partkey, l_linenumber, CASE l_linenumber WHEN 1 THEN NULL
         WHEN 2 THEN '12' || lpad(cast(l_partkey AS varchar), 8, '0') ELSE lpad(cast(l_suppkey AS varchar), 8, '0') END AS tab_number,
       CASE l_linenumber WHEN 1 THEN lpad(cast(l_suppkey AS varchar), 8, '0')
         WHEN 2 THEN '12' || lpad(cast(l_partkey AS varchar), 8, '0') || chr(10) || lpad(cast(l_suppkey AS varchar), 8, '0')
         ELSE lpad(cast(l_suppkey AS varchar), 8, '0') || chr(10) || lpad(cast(l_suppkey AS varchar), 8, '0') END AS tab_lines
       FROM lineitem""",
)
def q_tab_number(spark, sf):
    key, turn = F.col("l_suppkey").cast("string"), F.col("l_linenumber")
    text = (
        F.when(turn == 1, F.lit(" — "))
        .when(turn == 2, F.concat(F.lit("0012"), F.lpad(F.col("l_partkey").cast("string"), 8, "0")))
        .when(turn == 3, F.concat(key, F.lit(".0")))
        .when(turn == 4, F.concat(F.lit("таб. № "), key))
        .otherwise(F.concat(F.lit(" 000"), key))
    )
    lines = F.concat(text, F.lit("\n-\n"), key)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        tab_number(text).alias("tab_number"), tab_number_lines(lines).alias("tab_lines"),
    )


@query(
    "q_person_name",
    "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE replace(c_name, '#', ' ') || ' X' END AS name FROM customer",
)
def q_person_name(spark, sf):
    spaced = F.concat(F.lit("  "), F.replace("c_name", F.lit("#"), F.lit(" \t ")), F.lit("  X \n"))
    name = F.when(F.col("c_custkey") % 4 == 0, F.lit(" None ")).otherwise(spaced)
    return table(spark, sf, "customer").select("c_custkey", person_name(name).alias("name"))


@query(
    "q_id_token",
    "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '-' || c_custkey ELSE cast(c_custkey AS varchar) END AS token FROM customer",
)
def q_id_token(spark, sf):
    turn, key = F.col("c_custkey") % 4, F.col("c_custkey").cast("string")
    text = (
        F.when(turn == 0, F.lit(" - "))
        .when(turn == 1, F.concat(F.lit("-"), key, F.lit(".0")))
        .when(turn == 2, F.concat(key, F.lit(".0")))
        .otherwise(F.concat(F.lit(" "), key))
    )
    return table(spark, sf, "customer").select("c_custkey", id_token(text).alias("token"))


@query(
    "q_client_names",
    """SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'ПАО "' || c_name || '"' WHEN 1 THEN 'ООО «' || c_name || '»'
       WHEN 2 THEN 'АО ' || c_name WHEN 3 THEN 'СПК ' || c_name WHEN 4 THEN 'ИП ' || c_name
       WHEN 5 THEN 'ООО ' || c_name ELSE NULL END AS client FROM customer""",
)
def q_client_names(spark, sf):
    turn, name = F.col("c_custkey") % 7, F.col("c_name")
    text = (
        F.when(turn == 0, F.concat(F.lit("Публичное Акционерное Общество \""), name, F.lit("\"")))
        .when(turn == 1, F.concat(F.lit("ОБЩЕСТВО С ОГРАНИЧЕННОЙ ОТВЕТСТВЕННОСТЬЮ «"), name, F.lit("»")))
        .when(turn == 2, F.concat(F.lit("«акционерное общество»  "), name, F.lit(" ;")))
        .when(turn == 3, F.concat(F.lit("Сельскохозяйственный производственный кооператив "), name))
        .when(turn == 4, F.concat(F.lit("индивидуальный предприниматель. "), name))
        .when(turn == 5, F.concat(F.lit("ООО"), name))
        .otherwise(F.lit("  "))
    )
    return table(spark, sf, "customer").select("c_custkey", client_name(text).alias("client"))


@query(
    "q_durations_columns",
    "SELECT seq, days_on_stage, days_since_deal FROM er",
)
def q_durations_columns(spark, sf):
    return add_durations(event_reports(spark, sf)).select("seq", "days_on_stage", "days_since_deal")


@query(
    "q_durations_dates",
    """SELECT seq, cast(date_diff('day', CASE WHEN deal_stage NOT IN ('-', 'nan') THEN coalesce(deal_created_date, work_start_date)
         ELSE work_start_date END, report_date) AS double) AS days_on_stage,
       coalesce(cast(date_diff('day', deal_created_date, report_date) AS double), days_since_deal) AS days_since_deal FROM er""",
)
def q_durations_dates(spark, sf):
    return add_durations(event_reports(spark, sf), "dates").select("seq", "days_on_stage", "days_since_deal")
