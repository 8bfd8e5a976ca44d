"""Run a job: ``python -m palmyra {p1,p2,p3,p4} --warehouse ROOT [--as-of DATE]``.

p1 rebuilds the rainfall balance, p2 updates one month of it, p3 loads one
month of bunch weights (optionally exporting it as CSV), p4 prorates one year
of weighbridge loads. ``--as-of`` defaults to today, as the source jobs do.
"""

from __future__ import annotations

import argparse
import datetime as dt

from palmyra.functions.scalar import EPOCH
from palmyra.plans import jobs
from palmyra.session import get_session
from palmyra.sources.writers import clear_stages


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="palmyra")
    p.add_argument("job", choices=["p1", "p2", "p3", "p4"])
    p.add_argument("--warehouse", required=True, help="root folder of the warehouse tables")
    p.add_argument("--as-of", default=dt.date.today().isoformat())
    p.add_argument("--mode", choices=["reference", "intended"], default="reference")
    p.add_argument("--epoch", default="{}-{:02d}".format(*EPOCH),
                   help="P1 opening month, YYYY-MM")
    p.add_argument("--export", help="P3: CSV export folder")
    p.add_argument("--workbook", help="P3: folder for the export as spreadsheet workbooks")
    p.add_argument("--refuse-null-years", action="store_true",
                   help="P3/P4: end the job at a row without a planting year")
    p.add_argument("--exclude", help="P3/P4: comma-separated excluded division codes")
    p.add_argument("--code-len", type=int, help="P3/P4: required block-code length")
    p.add_argument("--master", help="Spark master (default: from spark-submit)")
    p.add_argument("--show", type=int, default=0, metavar="N",
                   help="print N rows of the refreshed slice after the run")
    a = p.parse_args(argv)

    spark = get_session(a.master)
    wh = jobs.Warehouse(a.warehouse)
    clean = {}
    if a.exclude is not None:
        clean["exclude"] = tuple(v for v in a.exclude.split(",") if v)
    if a.code_len is not None:
        clean["code_len"] = a.code_len
    if a.job == "p1":
        y, m = (int(v) for v in a.epoch.split("-"))
        jobs.run_initial_balance(spark, wh, epoch=(y, m), mode=a.mode)
    elif a.job == "p2":
        jobs.run_monthly_balance(spark, wh, a.as_of, mode=a.mode)
    elif a.job == "p3":
        jobs.run_bjr(spark, wh, a.as_of, export_path=a.export, workbook_path=a.workbook,
                     refuse_null_years=a.refuse_null_years, **clean)
    else:
        jobs.run_wb_actual(spark, wh, a.as_of, refuse_null_years=a.refuse_null_years, **clean)
    if a.show:
        _show(spark, wh, a.job, a.as_of, a.show)
    clear_stages(spark)


def _show(spark, wh, job: str, as_of, n: int) -> None:
    """Print a preview of what the job wrote, by estate (the source prints its
    frame)."""
    from palmyra.functions.periods import period_of
    y, m = period_of(as_of)
    if job == "p1":
        df = wh.read(spark, "rainfall_balance")
    elif job == "p2":
        df = wh.read(spark, "rainfall_balance", Tahun=y, Bulan=m)
    elif job == "p3":
        df = wh.read(spark, "bjr", Tahun=y, Bulan=m)
    else:
        df = wh.read(spark, "wb_actual", Year=y)
    # Sorting for the first n rows keeps n rows a task, not the table.
    df.orderBy("KodeKebun").show(n, truncate=False)


if __name__ == "__main__":
    main()
