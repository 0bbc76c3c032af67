"""Shared-SQL fixtures for the DuckDB oracle.

Each entry is one ``name AS (...)`` common table expression written in the
portable subset both engines accept (``e``-form double literals, ``concat``,
explicit casts).  ``with_ctes`` prepends the transitive closure of the
CTEs a query names, in dependency order.
"""

from __future__ import annotations

import re


def _h(a: int, key: str = "k") -> str:
    return f"((({key} + 1) * {a}) % 2147483647)"


def _u(a: int, key: str = "k") -> str:
    return f"({_h(a, key)} / 2147483647e0)"


def _pick(h: str, values) -> str:
    arms = " ".join(f"WHEN {h} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {arms} END"


_ADDON = ["Yes", "No", "No internet"]

CTES: dict[str, tuple[list[str], str]] = {}


def _def(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


_def("spend", [], """
  SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend,
         MAX(o_orderdate) AS last_o
  FROM orders GROUP BY o_custkey""")

_def("cr_base", ["spend"], f"""
  SELECT c.c_custkey AS k,
         concat('C', repeat('0', CAST(greatest(0, 6 - length(CAST(c.c_custkey AS VARCHAR))) AS INTEGER)), CAST(c.c_custkey AS VARCHAR)) AS customer_id,
         CAST(1 + {_h(62089911, 'c.c_custkey')} % 71 AS BIGINT) AS tenure_months,
         2e1 + (c.c_acctbal + 1e3) * 1.3e2 / 1.1e4 AS monthly_charges,
         coalesce(s.spend, 0e0) / 6e2 AS total_charges,
         CASE WHEN {_h(1103515245, 'c.c_custkey')} % 10 < 5 THEN 'Month-to-month'
              WHEN {_h(1103515245, 'c.c_custkey')} % 10 < 8 THEN 'One year' ELSE 'Two year' END AS contract_type,
         {_pick(_h(1664525003, 'c.c_custkey') + ' % 4', ['Electronic check', 'Mailed check', 'Credit card', 'Bank transfer'])} AS payment_method,
         CASE WHEN {_h(22695477, 'c.c_custkey')} % 10 < 4 THEN 'DSL'
              WHEN {_h(22695477, 'c.c_custkey')} % 10 < 8 THEN 'Fiber optic' ELSE 'No' END AS internet_service,
         CASE WHEN {_h(134775813, 'c.c_custkey')} % 10 < 9 THEN 'Yes' ELSE 'No' END AS phone_service,
         {_pick(_h(214013177, 'c.c_custkey') + ' % 3', ['Yes', 'No', 'No phone service'])} AS multiple_lines,
         {_pick(_h(1220703125, 'c.c_custkey') + ' % 3', _ADDON)} AS online_security,
         {_pick(_h(69069133, 'c.c_custkey') + ' % 3', _ADDON)} AS online_backup,
         {_pick(_h(1566083941, 'c.c_custkey') + ' % 3', _ADDON)} AS device_protection,
         {_pick(_h(1812433253, 'c.c_custkey') + ' % 3', _ADDON)} AS tech_support,
         {_pick(_h(747796405, 'c.c_custkey') + ' % 3', _ADDON)} AS streaming_tv,
         {_pick(_h(2024337845, 'c.c_custkey') + ' % 3', _ADDON)} AS streaming_movies,
         CASE WHEN {_h(1103527590, 'c.c_custkey')} % 10 < 6 THEN 'Yes' ELSE 'No' END AS paperless_billing,
         CAST({_h(630360016, 'c.c_custkey')} % 100 < 16 AS INTEGER) AS senior_citizen,
         CASE WHEN {_h(742938285, 'c.c_custkey')} % 2 = 0 THEN 'Yes' ELSE 'No' END AS partner,
         CASE WHEN {_h(950706376, 'c.c_custkey')} % 10 < 3 THEN 'Yes' ELSE 'No' END AS dependents,
         s.last_o AS created_at
  FROM customer c LEFT JOIN spend s ON c.c_custkey = s.o_custkey""")

_def("customers_k", ["cr_base"], f"""
  SELECT k, customer_id, tenure_months, monthly_charges, total_charges, contract_type, payment_method,
         internet_service, phone_service, multiple_lines, online_security, online_backup, device_protection,
         tech_support, streaming_tv, streaming_movies, paperless_billing, senior_citizen, partner, dependents,
         CAST({_u(1226874159)} < (CASE WHEN tenure_months < 12 THEN 3e-1 ELSE 0e0 END
                                 + CASE WHEN contract_type = 'Month-to-month' THEN 2.5e-1 ELSE 0e0 END
                                 + CASE WHEN monthly_charges > 100 THEN 2e-1 ELSE 0e0 END
                                 + CASE WHEN tech_support = 'No' THEN 1.5e-1 ELSE 0e0 END
                                 + CASE WHEN senior_citizen = 1 THEN 1e-1 ELSE 0e0 END) AS INTEGER) AS churned,
         created_at
  FROM cr_base""")

_def("customers_raw", ["customers_k"], """
  SELECT customer_id, tenure_months, monthly_charges, total_charges, contract_type, payment_method,
         internet_service, phone_service, multiple_lines, online_security, online_backup, device_protection,
         tech_support, streaming_tv, streaming_movies, paperless_billing, senior_citizen, partner, dependents,
         churned, created_at
  FROM customers_k""")

_def("dirty_changed", ["customers_k"], """
  SELECT k, customer_id,
         CASE WHEN k % 79 = 0 THEN CAST(-5 AS BIGINT) ELSE tenure_months END AS tenure_months,
         CASE WHEN k % 97 = 0 THEN CAST(NULL AS DOUBLE) ELSE monthly_charges END AS monthly_charges,
         total_charges,
         CASE WHEN k % 83 = 0 THEN CAST(NULL AS VARCHAR) ELSE contract_type END AS contract_type,
         CASE WHEN k % 89 = 0 THEN 'Bitcoin' ELSE payment_method END AS payment_method,
         internet_service, phone_service, multiple_lines, online_security, online_backup, device_protection,
         tech_support, streaming_tv, streaming_movies, paperless_billing, senior_citizen, partner, dependents,
         churned, created_at
  FROM customers_k""")

_def("customers_dirty", ["dirty_changed"], """
  SELECT * EXCLUDE (k) FROM dirty_changed
  UNION ALL
  SELECT * EXCLUDE (k) FROM dirty_changed WHERE k % 101 = 0""")

_def("prediction_log", [], """
  SELECT event_id, ts AS event_time,
         concat('C', repeat('0', CAST(greatest(0, 6 - length(CAST(user_id AS VARCHAR))) AS INTEGER)), CAST(user_id AS VARCHAR)) AS customer_id,
         value / (value + 5e1) AS churn_probability,
         CAST(value / (value + 5e1) >= 5e-1 AS INTEGER) AS prediction,
         value AS latency_ms,
         '1.0' AS model_version,
         CASE WHEN value / (value + 5e1) > 0e0 AND value / (value + 5e1) <= 4e-1 THEN 'LOW'
              WHEN value / (value + 5e1) > 4e-1 AND value / (value + 5e1) <= 7e-1 THEN 'MEDIUM'
              WHEN value / (value + 5e1) > 7e-1 AND value / (value + 5e1) <= 1e0 THEN 'HIGH' END AS risk_level,
         CAST(event_type = 'error' AS INTEGER) AS is_error
  FROM events""")


def define(name: str, deps: list[str], body: str) -> None:
    """Register another CTE (used by the per-area oracle modules)."""
    _def(name, deps, body)


def with_ctes(select: str, *names: str) -> str:
    """``WITH <closure of names> <select>``; names referenced in ``select``
    are picked up automatically when they match a registered CTE."""
    wanted = list(names) + [n for n in CTES if re.search(rf"\b{re.escape(n)}\b", select)]
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        deps, body = CTES[n]
        for d in deps:
            visit(d)
        # bodies may reference other CTEs without listing them
        for other in CTES:
            if other != n and other not in order and re.search(rf"\b{re.escape(other)}\b", body):
                visit(other)
        order.append(n)

    for n in wanted:
        visit(n)
    if not order:
        return select
    parts = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    body = select.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{select}"
