"""Write PLANS.md: per registered query, the shape of its physical plan.

Counts shuffle exchanges, broadcast exchanges, join kinds and scans in the
formatted plan (taken after one run, so AQE's final plan is shown), plus the
scan's ReadSchema width. Usage: python tests/plan_report.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, ".")


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def shape(text: str) -> dict:
    tree = text.split("\n\n")[0]
    return {
        "shuffles": len(re.findall(r"Exchange(?! SinglePartition)", tree)) - len(re.findall(r"BroadcastExchange|ReusedExchange", tree)),
        "broadcasts": len(re.findall(r"BroadcastExchange", tree)),
        "smj": len(re.findall(r"SortMergeJoin", tree)),
        "bhj": len(re.findall(r"BroadcastHashJoin", tree)),
        "scans": len(re.findall(r"Scan parquet", tree)),
        "read_cols": max([len(m.split(",")) for m in re.findall(r"ReadSchema: struct<(.*)>", text)] or [0]),
    }


def main(argv):
    from wellscore.plans.queries import queries
    from wellscore.plans.registry import REGISTRY
    from wellscore.session import local_session

    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    skip = {"stream_score", "stream_answers", "stream_dedupe", "stream_risk_window", "model_lr", "model_rf", "model_gbt", "model_gbt_sub", "cv_r2"}
    lines = [
        "# Physical plan shapes",
        "",
        f"Generated by `tests/plan_report.py` on {sf} (local[8], AQE on), after one run of each",
        "query. *shuffles* counts exchanges in the final plan: hash, round-robin (the spread of",
        "a one-split test file, absent on large inputs) and the single-partition step of a",
        "global aggregate (a few partial rows).",
        "*broadcasts* broadcast exchanges, *read cols* the widest parquet ReadSchema. Pre-pass",
        "jobs (one-row statistics read before the plan is built) are not in these plans.",
        "",
        "| query | ops | shuffles | broadcasts | SMJ | BHJ | scans | read cols |",
        "|---|---|---|---|---|---|---|---|",
    ]
    qs = queries()
    for name, e in REGISTRY.items():
        if name in skip:
            lines.append(f"| {name} | {e.ops} | – | – | – | – | – | – |")
            continue
        df = qs[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        s = shape(plan_text(df))
        lines.append(f"| {name} | {e.ops} | {s['shuffles']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | {s['scans']} | {s['read_cols']} |")
    lines.append("")
    lines.append("Skipped rows (–) are model fits and streams: Spark ML runs its own jobs, and stream plans live in the streaming query.")
    open("PLANS.md", "w").write("\n".join(lines) + "\n")
    print("\n".join(lines))


if __name__ == "__main__":
    main(sys.argv)
