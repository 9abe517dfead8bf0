"""Team rosters, leaders of leads and deals, contacts.

Leaders stay in long form (one row per id and person) through all joins; the
list of a lead is only built for output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellspark import constants as K
from dwellspark.functions.text import (
    id_token,
    is_empty,
    is_leader,
    person_name,
    role_label,
    strip,
    tab_number,
    team_type,
)


_NO_DATE = 2**31 - 1
#: Keys over which rows without an id are spread.
NOBODY_KEYS = 4096


def leaders_only(team: DataFrame, words: Sequence[str] = K.LEADER_WORDS) -> DataFrame:
    """Roster rows with the leader flag."""
    return team.filter(is_leader(F.col("is_leader"), words))


def split_team(
    team: DataFrame,
    lead_types: Sequence[str] = K.TEAM_LEAD_TYPES,
    deal_types: Sequence[str] = K.TEAM_DEAL_TYPES,
) -> tuple[DataFrame, DataFrame]:
    """Roster of the lead teams and roster of the deal teams; other types belong to neither."""
    kind = team_type(F.col("team_type"))
    return team.filter(kind.isin(list(lead_types))), team.filter(kind.isin(list(deal_types)))


def team_type_counts(team: DataFrame) -> DataFrame:
    """Rows per team: lead, deal, unassigned (neither type nor number) and unknown."""
    kind = team_type(F.col("team_type"))
    unassigned = kind.isin(["", "-", "—"]) & is_empty(F.col("member_tab_number"), K.EMPTY_NAME)
    label = (
        F.when(kind.isin(list(K.TEAM_LEAD_TYPES)), F.lit("lead"))
        .when(kind.isin(list(K.TEAM_DEAL_TYPES)), F.lit("deal"))
        .when(unassigned, F.lit("unassigned"))
        .otherwise(F.lit("unknown"))
    )
    return team.groupBy(label.alias("team")).agg(F.count(F.lit(1)).alias("roster_rows"))


def latest_leaders(team: DataFrame, id_col: str, fold_case: bool = False, seq: str = "seq") -> DataFrame:
    """Leaders on the newest report date of an id, then on the newest added date, one row per name.

    Ties stay. Ids where nobody has an added date keep everybody. Columns:
    id, name, tab_number, role, tb, seq (row order inside the id).
    """
    lead = leaders_only(team)
    columns = set(team.columns)
    null = F.lit(None)
    report = F.col("report_date").cast("date") if "report_date" in columns else F.lit("1970-01-01").cast("date")
    added = F.col("team_added_date").cast("date") if "team_added_date" in columns else null.cast("date")
    work = lead.select(
        id_token(F.col(id_col)).alias("id"),
        person_name(F.col("member")).alias("name"),
        report.alias("report_date"),
        added.alias("added"),
        (tab_number(F.col("member_tab_number")) if "member_tab_number" in columns else null.cast("string")).alias("tab_number"),
        (strip(F.col("role")) if "role" in columns else null.cast("string")).alias("role"),
        (strip(F.col("tb")) if "tb" in columns else null.cast("string")).alias("tb"),
        F.col(seq).alias("seq"),
    ).filter(F.col("id").isNotNull() & F.col("report_date").isNotNull())
    if fold_case:
        # This variant judges the newest date by named rows only.
        work = work.filter(F.col("name").isNotNull())
    # One row per id and name, with the newest pair of dates of that name and the
    # first row on it. Dates count backwards, so the newest is the smallest.
    name_key = F.lower("name") if fold_case else F.col("name")
    back = F.struct(
        (-F.unix_date("report_date")).alias("report"),
        F.coalesce(-F.unix_date("added"), F.lit(_NO_DATE)).alias("added"),
    )
    order = F.struct(back.alias("dates"), F.col("seq").alias("seq"))
    people = work.groupBy("id", name_key.alias("name_key")).agg(
        F.min_by(F.struct("name", "tab_number", "role", "tb"), order).alias("who"), F.min(order).alias("first")
    )
    # A name is current when its newest pair is the newest of the id. One row per name is left, so
    # the window over an id is as small as its team.
    newest = people.withColumn("newest", F.min("first.dates").over(Window.partitionBy("id")))
    named = newest.filter((F.col("first.dates") == F.col("newest")) & F.col("name_key").isNotNull())
    return named.select("id", "who.name", "who.tab_number", "who.role", "who.tb", F.col("first.seq").alias("seq"))


def attach_contacts(
    leaders: DataFrame, contacts: DataFrame, tab: str = "tab_number"
) -> DataFrame:
    """Both mail addresses next to a tab number; unknown numbers stay without."""
    c = contacts.select(F.col("tab_number").alias("c_tab"), "email_alpha", "email_sigma")
    return leaders.join(c, F.col(tab) == F.col("c_tab"), "left").drop("c_tab")


def contact_lookup(contacts: DataFrame, seq: str = "seq") -> DataFrame:
    """One row per tab number with the first non-empty address of each kind."""
    work = contacts.withColumns(
        {
            "tab_number": tab_number(F.col("tab_number")),
            "email_alpha": F.when(strip(F.col("email_alpha")) != "", strip(F.col("email_alpha"))),
            "email_sigma": F.when(strip(F.col("email_sigma")) != "", strip(F.col("email_sigma"))),
        }
    ).filter(F.col("tab_number").isNotNull())
    return work.groupBy("tab_number").agg(
        *[
            F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(seq))).alias(c)
            for c in ("email_alpha", "email_sigma")
        ]
    )


def _lines(field: str) -> Column:
    values = F.filter(F.transform(F.col("people"), lambda p: p[field]), lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(values) > 0, F.array_join(values, "\n"))


def _mail_lines(field: str) -> Column:
    numbered = F.filter(F.col("people"), lambda p: p["tab_number"].isNotNull())
    values = F.transform(numbered, lambda p: F.coalesce(p[field], F.lit("")))
    return F.when(F.exists(values, lambda x: x != ""), F.array_join(values, "\n"))


def leader_lines(leaders: DataFrame, prefix: str) -> DataFrame:
    """One row per id: the leaders as a list and as texts with one line per leader."""
    mails = [c for c in ("email_alpha", "email_sigma") if c in leaders.columns]
    fields = ["seq", "name", "tab_number", "role", "tb", *mails]
    people = leaders.groupBy("id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("people"))
    return people.select(
        "id",
        F.transform("people", lambda p: p.dropFields("seq")).alias(f"{prefix}_leaders"),
        _lines("tab_number").alias(f"{prefix}_leader_tab_numbers"),
        _lines("name").alias(f"{prefix}_leader_members"),
        _lines("role").alias(f"{prefix}_leader_roles"),
        _lines("tb").alias(f"{prefix}_leader_tbs"),
        *[_mail_lines(m).alias(f"{prefix}_leader_{m}") for m in mails],
    )


def attach_leaders(df: DataFrame, leaders: DataFrame, id_col: str, prefix: str) -> DataFrame:
    """Leader columns next to every row; empty ids match nobody."""
    lines = leader_lines(leaders, prefix).withColumnRenamed("id", "l_id")
    keyed = df.withColumn("_leader_key", _own_key(id_token(F.col(id_col))))
    return keyed.join(lines, F.col("_leader_key") == F.col("l_id"), "left").drop("l_id", "_leader_key")


def _own_key(key: Column) -> Column:
    """The key, or one of many that nobody has, so that rows without one do not meet in one task."""
    nobody = F.concat(F.lit("\u0000"), F.pmod(F.monotonically_increasing_id(), F.lit(NOBODY_KEYS)).cast("string"))
    return F.coalesce(key, nobody)


def _in_line(leaders: DataFrame, prefix: str) -> DataFrame:
    """Leaders with `<prefix>_no`, their number among those of an id."""
    number = F.row_number().over(Window.partitionBy("id").orderBy("seq", "name"))
    return leaders.select(
        *[F.col(c).alias(f"{prefix}_{c}") for c in ("id", "name", "tab_number", "role", "tb", "seq") if c in leaders.columns],
        number.alias(f"{prefix}_no"),
    )


def beside_leaders(
    base: DataFrame, lead_leaders: DataFrame, deal_leaders: DataFrame, lead: Column, deal: Column | None
) -> DataFrame:
    """Rows of `base` with the leaders of their lead (`_l_*`) and of their deal (`_d_*`), in one pass.

    A row comes once per leader of the lead, and its first copy once per leader of the deal, so both
    are there once each: `_l_here` says where a leader of the lead counts, `_first` where the row itself
    does. Both joins keep rows that have no leader.
    """
    with_lead = base.withColumn("_l_key", _own_key(lead)).join(
        _in_line(lead_leaders, "_l"), F.col("_l_key") == F.col("_l_id"), "left"
    )
    first = F.coalesce("_l_no", F.lit(1)) == 1
    key = F.when(first, deal) if deal is not None else F.lit(None).cast("string")
    both = with_lead.withColumn("_d_key", _own_key(key)).join(
        _in_line(deal_leaders, "_d"), F.col("_d_key") == F.col("_d_id"), "left"
    )
    once = F.coalesce("_d_no", F.lit(1)) == 1
    return both.withColumns({"_l_here": F.col("_l_no").isNotNull() & once, "_first": first & once}).drop("_l_key", "_d_key")


def team_entries(
    detail: DataFrame,
    lead_leaders: DataFrame,
    deal_leaders: DataFrame,
    keys: Sequence[str],
) -> DataFrame:
    """One row per record, person and role: lead leaders, deal leaders, manager, second manager."""
    own = [c for c in ("lead_id", "deal_id", "km", "vks") if c in detail.columns and c not in keys]
    base = detail.select(*keys, *own)
    deal = id_token(F.col("deal_id")) if "deal_id" in base.columns else None
    rows = beside_leaders(base, lead_leaders, deal_leaders, id_token(F.col("lead_id")), deal)
    no_order = F.lit(None).cast(lead_leaders.schema["seq"].dataType)

    def entry(here: Column, source: int, order: Column, name: Column, role: Column) -> Column:
        fields = (F.lit(source).alias("source"), order.alias("ord"), name.alias("name"), role.alias("role"))
        return F.when(here, F.struct(*fields))

    parts = [
        entry(F.col("_l_here"), 0, F.col("_l_seq"), F.col("_l_name"), role_label(K.LEAD_TEAM_PREFIX, F.col("_l_role"))),
        entry(F.col("_d_no").isNotNull(), 1, F.col("_d_seq"), F.col("_d_name"), role_label(K.DEAL_TEAM_PREFIX, F.col("_d_role"))),
    ]
    for source, column, role in ((2, "km", K.ROLE_KM), (3, "vks", K.ROLE_VKS)):
        if column in base.columns:
            name = person_name(F.col(column))
            parts.append(entry(F.col("_first") & name.isNotNull(), source, no_order, name, F.lit(role)))
    return rows.select(*keys, F.inline(F.array_compact(F.array(*parts))))


def compose_team(
    detail: DataFrame,
    lead_leaders: DataFrame,
    deal_leaders: DataFrame,
    keys: Sequence[str] = ("lead_id",),
) -> DataFrame:
    """One row per record and person, roles merged in the order in which they appear.

    A person has at most one role per source, so the role list is short.
    `keys` must identify a record and contain `lead_id`.
    """
    entries = team_entries(detail, lead_leaders, deal_leaders, keys)
    place = F.struct("source", "ord")
    person = entries.groupBy(*keys, F.lower("name").alias("name_key")).agg(
        F.min_by("name", place).alias("name"),
        F.min(place).alias("place"),
        F.array_sort(F.collect_list(F.struct("source", "ord", "role"))).alias("held"),
    )
    return person.select(*keys, "name", "place", distinct_roles(F.transform("held", lambda h: h["role"])).alias("roles"))


def distinct_roles(roles: Column) -> Column:
    """First of every role that differs in more than case; blanks dropped."""

    def add(seen: Column, role: Column) -> Column:
        known = F.exists(seen, lambda s: F.lower(s) == F.lower(role))
        return F.when(known | (F.trim(role) == ""), seen).otherwise(F.concat(seen, F.array(role)))

    return F.aggregate(roles, F.array().cast("array<string>"), add)
