"""Run named queries and their check SQL side by side: check.py <sf_dir> [name ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tests"))

from oracle import compare, duck, normal_rows  # noqa: E402

from tapeloom.session import local_session  # noqa: E402


def main() -> None:
    import importlib

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    for module in [w for w in wanted if w.startswith("@")]:
        importlib.import_module(f"tapeloom.plans.{module[1:]}")
    if any(w.startswith("@") for w in wanted):
        from tapeloom.plans.registry import PLANS

        own = {m[1:] for m in wanted if m.startswith("@")}
        names = [n for n, p in PLANS.items() if p.build.__module__.rsplit(".", 1)[1] in own]
    else:
        from tapeloom.plans import PLANS

        names = wanted or list(PLANS)
    spark, con = local_session(), duck(sf_dir)
    bad = 0
    for name in names:
        plan, start = PLANS[name], time.time()
        try:
            df = plan.build(spark, sf_dir)
            rows = normal_rows(df.columns, [tuple(r) for r in df.collect()])
        except Exception as error:  # report and go on to the next query
            bad += 1
            print(f"ERROR {name}: {str(error)[:600]}", flush=True)
            continue
        took = time.time() - start
        if plan.sql is None:
            print(f"rows  {name}: {len(rows)} rows, {took:.1f}s", flush=True)
            continue
        try:
            verdict = compare(con, plan.sql, df.columns, rows)
        except Exception as error:
            verdict = f"SQL error: {str(error)[:500]}"
        bad += verdict != "ok"
        print(f"{'ok   ' if verdict == 'ok' else 'DIFF '} {name}: {len(rows)} rows, {took:.1f}s {verdict if verdict != 'ok' else ''}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
