"""Render the scoring spec as DuckDB SQL text, for the independent oracle.

This is the test side of the correctness gate: the same formulas as
``operators/features.py`` written as SQL, with double literals and the same
operand order so both engines agree to the last bit.
"""

from __future__ import annotations

from wellscore.spec import DEFAULT_SPEC, Spec


def D(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def clip(x: str, lo: str, hi: str) -> str:
    return f"(CASE WHEN ({x}) < {lo} THEN {lo} WHEN ({x}) > {hi} THEN {hi} ELSE ({x}) END)"


def norm(c: str, hi: float, lo: float = 0.0) -> str:
    return clip(f"(({c} - {D(lo)}) / {D(hi - lo)})", D(0.0), D(1.0))


def rnd(x: str, digits: int) -> str:
    s = D(10**digits)
    return f"(round_even(({x}) * {s}, 0) / {s})"


def weighted(terms: list[tuple[float, str]]) -> str:
    out = ""
    for w, t in terms:
        if not out:
            out = f"{D(w)} * {t}" if w >= 0 else f"{D(0.0)} - {D(-w)} * {t}"
        elif w >= 0:
            out = f"({out}) + {D(w)} * {t}"
        else:
            out = f"({out}) - {D(-w)} * {t}"
    return f"({out})"


def index_exprs(spec: Spec = DEFAULT_SPEC, mode: str = "train") -> dict[str, str]:
    scale = spec.scale
    out = {}
    for index, terms in spec.index_terms.items():
        parts = []
        for feat, w, flip in terms:
            lo, hi = scale[feat]
            n = norm(feat, hi, lo)
            parts.append((w, f"({D(1.0)} - {n})" if flip else n))
        e = weighted(parts)
        out[index] = rnd(e, 4) if mode == "score" else e
    return out


def interaction_exprs(mode: str = "train") -> dict[str, str]:
    ratio = f"(anxiety_level / (sleep_quality + {D(1e-6)}))"
    burden = "((study_load + future_career_concerns) / 10)"
    if mode == "score":
        iso = f"(((5 - {norm('social_support', 3)} * 5) * (peer_pressure + 1)) / 6)"
        mental = f"(({norm('anxiety_level', 21)} + {norm('depression', 27)}) / 2)"
    else:
        sup = "(CASE WHEN social_support < 0 THEN 0 WHEN social_support > 3 THEN 3 ELSE social_support END)"
        iso = f"(((5 - ({sup} / 3) * 5) * (peer_pressure + 1)) / 6)"
        mental = "((anxiety_level / 21 + depression / 27) / 2)"
    env = "((living_conditions + safety + basic_needs) / 15)"
    cols = {
        "stress_sleep_ratio": ratio,
        "academic_burden": burden,
        "isolation_index": iso,
        "environment_quality": env,
        "mental_load": mental,
    }
    return {k: rnd(v, 3) for k, v in cols.items()}


def raw_expr(spec: Spec = DEFAULT_SPEC) -> str:
    return weighted([(w, idx) for idx, w in spec.score_terms])


def minmax_expr(raw: str = "raw_score", mn: str = "mn", mx: str = "mx") -> str:
    return f"(CASE WHEN {mx} > {mn} THEN {rnd(f'(({raw} - {mn}) / ({mx} - {mn})) * {D(100.0)}', 2)} ELSE {D(0.0)} END)"


def select_list(exprs: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in exprs.items())


def band_expr(c: str, low: float = 33.0, mod: float = 66.0) -> str:
    return f"(CASE WHEN {c} <= {D(low)} THEN 'Low' WHEN {c} <= {D(mod)} THEN 'Moderate' ELSE 'High' END)"


def grid_mean(c: str, scale: float) -> str:
    return f"(CAST(sum(CAST(round_even(({c}) * {D(scale)}, 0) AS BIGINT)) AS DOUBLE) / (CAST(count({c}) AS DOUBLE) * {D(scale)}))"
