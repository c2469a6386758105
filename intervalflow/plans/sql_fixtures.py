"""DuckDB twins of :mod:`intervalflow.plans.fixtures`, as named CTEs for the oracle SQL.

The driver registers the given tables as views; every CTE here reads only those.
"""

from __future__ import annotations

from .fixtures import TARIFF_ELECTRICITY, TARIFF_GAS

_KIND = "CASE WHEN user_id % 2 = 0 THEN 'electricity' ELSE 'gas' END"
_TARIFF = f"CASE WHEN user_id % 2 = 0 THEN '{TARIFF_ELECTRICITY}' ELSE '{TARIFF_GAS}' END"
_METER = (f"{_KIND} AS kind, lpad(CAST(user_id AS VARCHAR), 10, '0') AS mpan_mprn, "
          f"'S' || CAST(user_id % 7 AS VARCHAR) AS serial, {_TARIFF} AS tariff_code")


def money(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,6)) AS DOUBLE)"


CTES: dict[str, tuple[str, list[str]]] = {
    "cons_raw": (f"""
        SELECT event_id, {_METER},
               time_bucket(INTERVAL 30 MINUTE, ts) AS interval_start,
               time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS interval_end,
               CAST(value AS DECIMAL(18,2)) AS consumption
        FROM events""", []),
    "cons": ("""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY kind, mpan_mprn, serial, interval_start, interval_end
                                       ORDER BY event_id) AS rn
          FROM cons_raw) WHERE rn = 1""", ["cons_raw"]),
    "signups": (f"""
        SELECT user_id, {_KIND} AS kind, time_bucket(INTERVAL 30 MINUTE, ts) AS valid_from, value,
               CAST(json_extract(props, '$.k') AS INTEGER) AS k
        FROM events WHERE event_type = 'signup'""", []),
    "rates_g": (f"""
        SELECT CASE WHEN kind = 'electricity' THEN '{TARIFF_ELECTRICITY}' ELSE '{TARIFF_GAS}' END AS tariff_code,
               valid_from, max(value) AS vmax, max(k) AS n
        FROM signups GROUP BY kind, valid_from""", ["signups"]),
    "rates": ("""
        SELECT tariff_code, valid_from,
               CASE WHEN n % 5 = 0 THEN valid_from + INTERVAL 15 MINUTE
                    WHEN n % 7 = 0 THEN NULL
                    ELSE lead(valid_from) OVER (PARTITION BY tariff_code ORDER BY valid_from) END AS valid_to,
               CAST(CAST(vmax AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS value_inc_vat
        FROM rates_g""", ["rates_g"]),
    "rates_overlap": ("""
        SELECT tariff_code, valid_from, valid_from + INTERVAL 6 HOUR AS valid_to,
               CAST(CAST(vmax AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS value_inc_vat
        FROM rates_g""", ["rates_g"]),
    "rates_many": ("""
        SELECT (CASE WHEN user_id % 2 = 0 THEN 'E' ELSE 'G' END) || '-1R-USER' || CAST(user_id AS VARCHAR) || '-A'
                 AS tariff_code,
               valid_from,
               CASE WHEN max(k) % 5 = 0 THEN valid_from + INTERVAL 15 MINUTE
                    WHEN max(k) % 7 = 0 THEN NULL
                    ELSE lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) END AS valid_to,
               CAST(CAST(max(value) AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS value_inc_vat
        FROM signups GROUP BY user_id, valid_from""", ["signups"]),
    "cons_many": ("""
        SELECT * REPLACE ((CASE WHEN CAST(mpan_mprn AS BIGINT) % 2 = 0 THEN 'E' ELSE 'G' END) || '-1R-USER'
                          || CAST(CAST(mpan_mprn AS BIGINT) AS VARCHAR) || '-A' AS tariff_code)
        FROM cons""", ["cons"]),
    # as-of: greatest valid_from <= interval_start per tariff, then the valid_to check
    "asof_left": ("""
        SELECT c.*, r.valid_from AS rate_valid_from, r.valid_to AS rate_valid_to,
               r.value_inc_vat AS rate_value_inc_vat,
               (r.valid_from IS NOT NULL AND (r.valid_to IS NULL OR c.interval_start < r.valid_to)) AS matched
        FROM cons c ASOF LEFT JOIN rates r
          ON c.tariff_code = r.tariff_code AND c.interval_start >= r.valid_from""", ["cons", "rates"]),
    "costed_left": ("""
        SELECT * EXCLUDE (matched, rate_valid_from, rate_valid_to, rate_value_inc_vat),
               CASE WHEN matched THEN rate_valid_from END AS rate_valid_from,
               CASE WHEN matched THEN rate_valid_to END AS rate_valid_to,
               CASE WHEN matched THEN rate_value_inc_vat END AS unit_rate,
               CASE WHEN matched THEN consumption * rate_value_inc_vat END AS cost
        FROM asof_left""", ["asof_left"]),
    # disjoint as-of segments [valid_from, least(next, valid_to))
    "segments": ("""
        SELECT *, least(lead(valid_from) OVER (PARTITION BY tariff_code ORDER BY valid_from), valid_to) AS seg_end
        FROM rates""", ["rates"]),
}


def with_ctes(*names: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, in dependency order."""
    order: list[str] = []

    def visit(n: str):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n"


def tariff_code_sql(key: str = "o_orderkey", prio: str = "o_orderpriority") -> str:
    letter = f"(CASE WHEN {key} % 4 = 2 THEN 'G' ELSE 'E' END)"
    return (f"(CASE WHEN {key} % 11 = 0 THEN {letter} || '-1R' ELSE {letter} || '-1R-' || replace({prio}, ' ', '') "
            f"|| CASE WHEN {key} % 2 = 1 THEN '-BB' ELSE '-A' END END)")


def parse_sql(parts: str) -> dict[str, str]:
    """P7 over a DuckDB list ``parts`` (1-based)."""
    n = f"len({parts})"
    has_region = f"(length({parts}[{n}]) = 1)"
    core_len = f"(CASE WHEN {has_region} THEN {n} - 3 ELSE {n} - 2 END)"
    core_end = f"(CASE WHEN {has_region} THEN {n} - 1 ELSE {n} END)"
    return {
        "kind": f"substr({parts}[1], 1, 1)",
        "register": f"CASE WHEN {n} >= 3 THEN {parts}[2] END",
        "product_code": f"CASE WHEN {n} >= 3 AND {core_len} > 0 THEN array_to_string({parts}[3:{core_end}], '-') END",
        "region": f"CASE WHEN {n} >= 3 AND {has_region} THEN {parts}[{n}] END",
    }


def energy_sql(code: str) -> str:
    return f"CASE WHEN starts_with({code}, 'E-') OR contains({code}, '-E-') THEN 'electricity' ELSE 'gas' END"
