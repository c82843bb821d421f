"""The linear model as DuckDB SQL, for the oracle: least squares of smallest norm by conjugate gradients.

The features are exactly collinear (the indices are sums of indicators), so the normal equations are
singular; started at zero, conjugate gradients over standardised columns end at the solution of
smallest norm.
"""

from __future__ import annotations

from wellscore.spec import MODEL_FEATURES, TARGET_COL


def linear_ctes(train: str) -> str:
    """CTEs up to `lc`, one row with the list c: intercept and slopes in MODEL_FEATURES order, fitted on the relation ``train`` (needs WITH RECURSIVE)."""
    cols = [*[f"CAST({c} AS DOUBLE)" for c in MODEL_FEATURES], TARGET_COL]
    k = len(MODEL_FEATURES)
    plus = "list_transform(range({k}), lambda i: {a}[i + 1] + {f} * {b}[i + 1])".replace("{k}", str(k))
    a_ = "(rr / list_dot_product(p, q))"
    next_r = plus.format(a="r", f=f"(-{a_})", b="q")
    return f"""lx AS (SELECT respondent_id, unnest(range({k + 1})) AS i, unnest([{", ".join(cols)}]) AS x FROM {train}),
lm AS (SELECT i, avg(x) AS m, CASE WHEN i = {k} THEN 1 ELSE stddev_pop(x) END AS s FROM lx GROUP BY i),
lz AS (SELECT respondent_id, i, (x - m) / s AS z FROM lx JOIN lm USING (i)),
lg AS (SELECT a.i, b.i AS j, avg(a.z * b.z) AS g FROM lz a JOIN lz b USING (respondent_id) WHERE a.i < {k} GROUP BY a.i, b.i),
ln AS (SELECT (SELECT list(r ORDER BY i) FROM (SELECT i, list(g ORDER BY j) AS r FROM lg WHERE j < {k} GROUP BY i)) AS g, (SELECT list(g ORDER BY i) FROM lg WHERE j = {k}) AS r),
lw(t, x, r, p, rr, first) AS (SELECT 0, list_transform(range({k}), lambda i: CAST(0 AS DOUBLE)), r, r, list_dot_product(r, r), list_dot_product(r, r) FROM ln UNION ALL
  SELECT t + 1, x, r, {plus.format(a="r", f="(list_dot_product(r, r) / rr)", b="p")}, list_dot_product(r, r), first FROM
    (SELECT t, {plus.format(a="x", f=a_, b="p")} AS x, {next_r} AS r, p, rr, first FROM
      (SELECT lw.*, list_transform(ln.g, lambda row: list_dot_product(row, p)) AS q FROM lw, ln WHERE t < 80 AND rr > 1e-28 * first))),
lb AS (SELECT x FROM lw ORDER BY t DESC LIMIT 1),
ls AS (SELECT list(m ORDER BY i) AS m, list(s ORDER BY i) AS s FROM lm),
lc AS (SELECT list_prepend(m[{k + 1}] - list_sum(list_transform(range({k}), lambda i: x[i + 1] / s[i + 1] * m[i + 1])), list_transform(range({k}), lambda i: x[i + 1] / s[i + 1])) AS c FROM lb, ls)"""


def prediction() -> str:
    """The prediction for a row of a relation joined with `lc`."""
    return "(" + " + ".join(["c[1]", *[f"c[{i + 2}] * {f}" for i, f in enumerate(MODEL_FEATURES)]]) + ")"
