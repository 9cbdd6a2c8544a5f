"""SQL fragments the equivalents are put together from."""

from __future__ import annotations

EVENT_CODES = """SELECT cast(c_custkey AS varchar) AS code, c_name AS name,
    c_mktsegment AS industry FROM customer"""

EVENT_REPORTS = """SELECT cast(user_id AS varchar) AS code,
    cast(strftime(ts, '%Y%m%d') AS integer) AS date, event_id AS shorts,
    cast(regexp_extract(props, '([0-9]+)', 1) AS bigint) AS total, value AS percent,
    event_id, event_type FROM events"""

EVENT_POSITIONS = f"""SELECT code, date, arg_max(shorts, event_id) AS shorts,
    arg_max(total, event_id) AS total, arg_max(percent, event_id) AS percent
    FROM ({EVENT_REPORTS}) r GROUP BY code, date"""

LINEITEM_CODES = """SELECT cast(s_suppkey AS varchar) AS code, s_name AS name,
    n_name AS industry FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

_LINEITEM_ORDER = "row(l_extendedprice, l_orderkey, l_linenumber)"
LINEITEM_POSITIONS = f"""SELECT cast(l_suppkey AS varchar) AS code,
    cast(strftime(l_shipdate, '%Y%m%d') AS integer) AS date,
    arg_max(cast(l_quantity AS bigint), {_LINEITEM_ORDER}) AS shorts,
    arg_max(l_orderkey, {_LINEITEM_ORDER}) AS total,
    arg_max(l_extendedprice, {_LINEITEM_ORDER}) AS percent
    FROM lineitem GROUP BY 1, 2"""

EVENT_DAY = "(SELECT max(cast(ts AS date)) FROM events)"
LINEITEM_DAY = "DATE '2001-10-16'"


def snapshots(codes: str, positions: str) -> str:
    return f"""SELECT d.date, c.code, c.name, coalesce(p.shorts, 0) AS shorts,
    coalesce(p.total, 0) AS total, coalesce(p.percent, 0) AS percent, c.industry
    FROM ({codes}) c
    CROSS JOIN (SELECT DISTINCT date FROM ({positions}) q) d
    LEFT JOIN ({positions}) p ON p.code = c.code AND p.date = d.date"""


EVENT_SNAPSHOTS = snapshots(EVENT_CODES, EVENT_POSITIONS)
LINEITEM_SNAPSHOTS = snapshots(LINEITEM_CODES, LINEITEM_POSITIONS)
EVENT_SNAPSHOT = f"""SELECT * FROM ({EVENT_SNAPSHOTS}) s
    WHERE date = cast(strftime({EVENT_DAY}, '%Y%m%d') AS integer)"""


def number(day: str) -> str:
    return f"cast(strftime({day}, '%Y%m%d') AS integer)"


def text(day: str) -> str:
    return f"strftime({day}, '%Y%m%d')"


def months_back(day: str, months: int) -> str:
    return (
        f"cast(date_trunc('month', {day}) - {months} * interval 1 month"
        f" + (day({day}) - 1) * interval 1 day AS date)"
    )


def days_back(day: str, days: int) -> str:
    return f"(cast({day} AS date) - {days})"


def to_weekday(day: str) -> str:
    return f"({day} - cast(greatest(isodow({day}) - 5, 0) AS integer))"


def shifted(period: str, day: str) -> str:
    return {
        "year": months_back(day, 12),
        "month": months_back(day, 1),
        "week": days_back(day, 7),
        "day": days_back(day, 1),
        "latest": f"cast({day} AS date)",
    }[period]


def anchor(period: str, day: str) -> str:
    return number(to_weekday(shifted(period, day)))


def business_days_back(day: str, days: int) -> str:
    """Count back over the calendar: the day before the n-th weekday going back."""
    return f"""(SELECT cast(s.t AS date) - 1 FROM (
        SELECT t, row_number() OVER (ORDER BY t DESC) AS n
        FROM unnest(generate_series({day}::timestamp - interval 40 day, {day}::timestamp,
            interval 1 day)) g(t)
        WHERE isodow(t) <= 5) s WHERE s.n = {days})"""


HORIZONS = ("day", "week", "month", "year")


def changes(snapshots: str, day: str) -> str:
    """Per code of the latest day its four changes, by outer joins."""
    anchors = {h: anchor(h, day) for h in ("latest", *HORIZONS)}
    joins = "\n".join(
        f"LEFT JOIN snap {h}_s ON {h}_s.code = l.code AND {h}_s.date = {anchors[h]}"
        for h in HORIZONS
    )
    columns = ", ".join(f"l.percent - {h}_s.percent AS {h}" for h in HORIZONS)
    return f"""WITH snap AS MATERIALIZED (
        SELECT * FROM ({snapshots}) s WHERE date IN ({", ".join(anchors.values())}))
    SELECT l.code, {columns} FROM snap l
    {joins}
    WHERE l.date = {anchors['latest']}"""


def coded_movers(snapshots: str, day: str) -> str:
    columns = ", ".join(
        f'coalesce({h}, -99999999.0) AS "{h.title()}Change"' for h in HORIZONS
    )
    return f'SELECT code AS "Code", {columns} FROM ({changes(snapshots, day)}) c'


def ordered_movers(
    snapshots: str, day: str, direction: str = "ASC", ranks: int = 99
) -> str:
    legs = ", ".join(
        f"""{h}_r AS (SELECT code, coalesce({h}, -99999999.0) AS change, row_number() OVER
        (ORDER BY abs({h}) {direction} NULLS LAST, code) AS n FROM ch)"""
        for h in HORIZONS
    )
    columns = ", ".join(
        f'{h}_r.code AS "{h.title()}Code", {h}_r.change AS "{h.title()}Change"'
        for h in HORIZONS
    )
    joins = " ".join(f"LEFT JOIN {h}_r ON {h}_r.n = day_r.n" for h in HORIZONS[1:])
    return f"""WITH ch AS MATERIALIZED ({changes(snapshots, day)}), {legs}
    SELECT cast(day_r.n AS integer) AS "Position", {columns} FROM day_r {joins}
    WHERE day_r.n <= {ranks}"""


def ranked(rows: str, where: str = "") -> str:
    return f"""SELECT * FROM (SELECT row_number() OVER (ORDER BY percent DESC, code) - 1
    AS "Position", code AS "Code", percent AS "Percent" FROM ({rows}) s) t {where}"""
