"""Write PLANS.md: the physical operator tree of the headline queries.

    python tests/plans_report.py [sf_dir]

Only the tree part of ``explain("formatted")`` is kept, after execution, so
adaptive decisions (broadcast conversion, coalesced partitions, skew splits)
are visible. Materialised stages appear as scans of checkpointed data.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEYS = ("product_area_impact", "account_risk_scores", "acct_base_features_user", "area_base_features",
        "retrain_decisions", "promotion_decisions", "latest_version_metrics", "version_history",
        "feedback_profile", "classification_metrics", "upsert_scores", "insert_new_feedback")


def tree(df) -> str:
    df.collect()  # runs this DataFrame's own query execution, so the adaptive plan is final
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [ln.rstrip() for ln in plan.splitlines() if ln.strip()]
    return "\n".join(ln if len(ln) < 160 else ln[:157] + "..." for ln in lines)


def main(argv: list[str]) -> None:
    from voxlens.session import local_session

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    qs = entry.queries()
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tests/plans_report.py` at `{sf_dir}` on `local[8]` (final adaptive plans).", ""]
    for key in KEYS:
        doc = (qs[key].__doc__ or "").strip().splitlines()[0]
        out += [f"## `{key}`", "", doc, "", "```", tree(qs[key](spark, sf_dir)), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
