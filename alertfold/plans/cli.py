"""Command line: ``python -m alertfold <command> --input DIR --output DIR [--dry-run]``.

recompose   current pipeline (positional alignment, key dedup, cascade, months + undated)
capped      strict dates, per-file epoch unit, date cap, audits of undated / over-cap rows
merge       generic merger of comma CSVs (date column detected per file, content dedup)
route       row router (date in a fixed cell, per-file ok / error counters)
rename      planned export renames (English or French rules), optionally applied
week        previous Monday..Sunday range and the export name for a day
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import functions as F


def _session():
    from alertfold.session import get_session
    return get_session()


def _print_counts(df, by="ym"):
    # one row per month: bounded by the number of months
    for r in df.groupBy(by).count().orderBy(by).collect():
        print(f"{r[by]}\t{r['count']}")


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="alertfold", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="cmd", required=True)

    def io(sp, out_default="alertes_merged", sep=";"):
        sp.add_argument("--input", "-i", default="alertes", nargs="+", help="input folder(s)")
        sp.add_argument("--output", "-o", default=out_default, help="output folder")
        sp.add_argument("--dry-run", action="store_true", help="plan and count, write nothing")
        sp.add_argument("--sep", default=sep)
        sp.add_argument("--encoding", default="UTF-8")

    r = sub.add_parser("recompose")
    io(r, "alertes_recomposees")
    r.add_argument("--null-key", choices=["collapse", "keep"], default="collapse")
    r.add_argument("--dedup-scope", choices=["global", "month"], default="global")
    r.add_argument("--header-from", choices=["path_max", "mtime"], default="path_max")
    r.add_argument("--drop-bad-files", action="store_true")
    r.add_argument("--exact-names", metavar="DIR", help="also publish alertes_YYYY_MM.csv files into DIR")
    r.add_argument("--no-bom", action="store_true")
    r.add_argument("--prefer-dated", action="store_true", help="of rows with one key keep the first dated one")
    r.add_argument("--epoch-tz", metavar="ZONE", help="zone of the date texts, e.g. Europe/Paris, for the epochs too")

    c = sub.add_parser("capped")
    io(c, "alertes_renommees")
    c.add_argument("--cap", required=True, help="e.g. '2025-11-16 23:59:59'")
    c.add_argument("--header-fix", choices=["mojibake", "accents"])
    c.add_argument("--exact-names", metavar="DIR", help="write months and audits under their file names into DIR instead")

    m = sub.add_parser("merge")
    io(m, sep=",")
    m.add_argument("--compare", choices=["name", "position"], default="name", help="how rows of different headers are compared")

    ro = sub.add_parser("route")
    io(ro, "output_by_month")
    ro.add_argument("--date-index", type=int, default=1)
    ro.add_argument("--align", action="store_true", help="put the cells of all files in the columns of a common header")

    rn = sub.add_parser("rename")
    rn.add_argument("--input", "-i", default="alertes_a_renommer")
    rn.add_argument("--language", choices=["en", "fr"], default="en")

    w = sub.add_parser("week")
    w.add_argument("--today", type=dt.date.fromisoformat, default=dt.date.today())

    a = p.parse_args(argv)
    spark = _session()
    from alertfold.plans import pipelines as P
    from alertfold.sources import csv as C

    if a.cmd == "recompose":
        csv = C.CsvOptions(sep=a.sep, encoding=a.encoding, header_from=a.header_from)
        _, failed = C.split_failed(spark, C.discover(spark, a.input, csv), csv)
        for path, error in sorted(failed.items()):           # one line per failed file
            print(f"{error}\t{path}", file=sys.stderr)
        opts = P.RecomposeOptions(csv=csv, null_key=a.null_key, dedup_scope=a.dedup_scope,
                                  bad_files="drop" if a.drop_bad_files else "keep", failed="skip" if failed else "raise",
                                  prefer_dated=a.prefer_dated, epoch_tz=a.epoch_tz)
        df, header = P.recompose(spark, a.input, opts)
        if a.dry_run:
            _print_counts(df)
            return 0
        P.write_recomposed(df, header, a.output, bom=not a.no_bom)
        if a.exact_names:
            from alertfold.sinks.files import publish_month_files
            print("\n".join(publish_month_files(spark, a.output + "/status=ok", a.exact_names)))
    elif a.cmd == "capped":
        df = P.capped(spark, a.input, a.cap, C.CsvOptions(sep=a.sep, encoding=a.encoding, header_fix=a.header_fix))
        if a.dry_run:
            _print_counts(df, "status")
            return 0
        if a.exact_names:
            print(json.dumps(P.write_capped_named(df, a.exact_names, header_fix=a.header_fix)))
        else:
            P.write_capped(df, a.output, header_fix=a.header_fix)
    elif a.cmd == "merge":
        kept, det = P.merge(spark, a.input, C.CsvOptions(sep=a.sep, encoding=a.encoding, exclude=()), a.compare)
        if a.dry_run:
            _print_counts(kept)
            return 0
        P.write_merged(kept, a.output, det)
    elif a.cmd == "route":
        files = C.discover(spark, a.input, C.CsvOptions(sep=a.sep, exclude=()))
        if a.align:
            routed, header = P.route_aligned(spark, files, a.date_index, a.sep, a.encoding)
        else:
            routed = P.route(spark, files, a.date_index, a.sep, a.encoding)
            first = C.header_lines(spark, files[:1], C.CsvOptions(sep=a.sep, encoding=a.encoding)).first()
            header = first["line"].lstrip("\ufeff") if first else "value"
        from alertfold.operators import quality
        stats = quality.file_stats(routed, C.SOURCE, F.col("ok"))
        for row in stats.orderBy("file_name").collect():     # one row per file
            print(json.dumps(row.asDict()))
        if not a.dry_run:
            P.write_routed(routed, header, a.output)
    elif a.cmd == "rename":
        from alertfold.functions.names import rewrite_name
        listing = C.listing(spark, a.input, C.CsvOptions(exclude=()))
        plan = listing.select("file_name", rewrite_name(F.col("file_name"), a.language).alias("target"))
        for row in plan.orderBy("file_name").collect():      # one row per file name
            print(f"{row['file_name']}\t{row['target'] or 'UNRECOGNISED'}")
    elif a.cmd == "week":
        from alertfold.functions import dates as D
        from alertfold.functions.names import range_file_base
        d = spark.createDataFrame([(a.today,)], "d date")
        s, e = D.previous_week_start(F.col("d")), D.previous_week_end(F.col("d"))
        row = d.select(s.alias("start"), e.alias("end"), range_file_base(s, e).alias("name")).first()
        print(f"{row['start']}\t{row['end']}\t{row['name']}.csv")
    return 0


if __name__ == "__main__":
    sys.exit(main())
