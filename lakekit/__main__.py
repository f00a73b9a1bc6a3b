"""Command line: run the refinement jobs, business queries and validation.

    python -m lakekit sales --items ITEMS.csv --products PRODUCTS.csv --output LOCATION
    python -m lakekit employees --sheet HR.csv --output LOCATION [--load-date 2024-01-01]
    python -m lakekit query cross_domain --sales LOC --employees LOC --results ROOT
    python -m lakekit sql FILE.sql --sales LOC --employees LOC --results ROOT
    python -m lakekit validate --sales LOC --employees LOC --raw items=ITEMS.csv ...
    python -m lakekit refresh --lake-root ROOT --items I.csv --products P.csv --sheet HR.csv
    python -m lakekit discover PATH [--table db.t [--lake-root ROOT --principal P --apply]]
    python -m lakekit discover PATH --table db.t --apply --location LOC   (widening and nested changes too)
    python -m lakekit crawl ROOT
    python -m lakekit partitions db.t LOCATION [--repair --principal P]
    python -m lakekit changes DIR [--glob '*.csv'] [--no-digest] [--previous MANIFEST] [--save MANIFEST]
    python -m lakekit split CSV --kept OUT --quarantined OUT [--unquoted]
    python -m lakekit reconcile LEFT RIGHT --key COLUMN [--leaf N]
    python -m lakekit lineage FILE.sql --sales LOC --employees LOC

Jobs write a fresh version folder under the table location and print its
path (``--lake-root`` also registers and repoints the catalog table).
Queries run as a principal (governed columns), save a headered CSV result
under ``<results>/<query>/run_date=<day>/`` and print a 10-row preview.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from lakekit import catalog as C
from lakekit import crawl as W
from lakekit import expect as X
from lakekit import lineage
from lakekit import policy as G
from lakekit import reconcile as R
from lakekit import sinks as K
from lakekit.contracts import ANALYTICS, EMPLOYEE_CONTRACT, SALES_CONTRACT
from lakekit.plans import business as B
from lakekit.plans.jobs import conform_employees, conformance_report, sales_by_category
from lakekit.plans.lake import RawDeliveries, refresh_lake
from lakekit.session import get_session
from lakekit.sources import manifest as M
from lakekit.sources.files import read_raw_csv, read_refined
from lakekit.sources.quarantine import split_csv
from lakekit.validate import validate_lake

QUERIES = {
    "executive_kpis": lambda s, e, spark: B.executive_kpis(s, e),
    "top_categories": lambda s, e, spark: B.top_categories(s, 20),
    "top10_share": lambda s, e, spark: B.top_share(s, 10),
    "satisfaction_by_department": lambda s, e, spark: B.satisfaction_by(e),
    "turnover_by_department": lambda s, e, spark: B.turnover_by(e),
    "low_satisfaction": lambda s, e, spark: B.low_satisfaction(e),
    "cross_domain": lambda s, e, spark: B.cross_domain(s, e, B.REFERENCE_BUSINESS_MAP),
    "sales_totals": lambda s, e, spark: B.sales_totals(s),
    "headcount": lambda s, e, spark: B.headcount(e),
    "top5_categories": lambda s, e, spark: B.top_categories_raw(s, 5),
    "sample_employees": lambda s, e, spark: K.preview(e.select("departamento", "cargo", "satisfacao", "rotatividade"), 5),
}


def _publish(spark, df, contract, location, lake_root):
    if lake_root:
        C.register_domain(spark, contract.domain, lake_root)
    path = K.write_refined(df, contract, location)
    if lake_root and not spark.catalog.tableExists(contract.qualified_name):
        C.register_table(spark, contract, path)
    print(path)


def _print_preview(df, n=10):
    rows = df.take(n)
    print(",".join(df.columns))
    for r in rows:
        print(",".join("" if v is None else str(v) for v in r))


def _print_all(df):
    """Every row, fetched partition by partition."""
    print(",".join(df.columns))
    for r in df.toLocalIterator():
        print(",".join("" if v is None else str(v) for v in r))


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="lakekit")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("sales", help="items + products CSV -> revenue per category (versioned Parquet)")
    s.add_argument("--items", required=True)
    s.add_argument("--products", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--lake-root")
    e = sub.add_parser("employees", help="adaptive HR sheet CSV -> 14-column employee table")
    e.add_argument("--sheet", required=True)
    e.add_argument("--output", required=True)
    e.add_argument("--load-date")
    e.add_argument("--lake-root")
    q = sub.add_parser("query", help="run a business query as a principal; CSV result + preview")
    q.add_argument("name", choices=sorted(QUERIES))
    q.add_argument("--sales", required=True)
    q.add_argument("--employees", required=True)
    q.add_argument("--results")
    q.add_argument("--principal", default=ANALYTICS)
    q.add_argument("--run-date", default=str(dt.date.today()))
    x = sub.add_parser("sql", help="run the Spark SQL statements of a file as a principal")
    x.add_argument("file")
    x.add_argument("--sales", required=True)
    x.add_argument("--employees", required=True)
    x.add_argument("--results")
    x.add_argument("--principal", default=ANALYTICS)
    x.add_argument("--run-date", default=str(dt.date.today()))
    v = sub.add_parser("validate", help="checks over refined tables, raw inputs and grants")
    v.add_argument("--sales", required=True)
    v.add_argument("--employees", required=True)
    v.add_argument("--raw", action="append", default=[], help="name=path of a raw CSV input")
    r = sub.add_parser("refresh", help="refine both domains, publish, register and validate")
    r.add_argument("--lake-root", required=True)
    r.add_argument("--items", required=True)
    r.add_argument("--products", required=True)
    r.add_argument("--sheet", required=True)
    r.add_argument("--load-date")
    d = sub.add_parser("discover", help="widened schema of Parquet files; drift against a registered table")
    d.add_argument("path")
    d.add_argument("--glob", default="*.parquet")
    d.add_argument("--table")
    d.add_argument("--apply", action="store_true")
    d.add_argument("--location", help="versioned location of the table: also widen types and change nested columns, by a new version")
    d.add_argument("--lake-root", default="lake")
    d.add_argument("--principal")
    c = sub.add_parser("changes", help="raw file manifest and changes since a saved manifest")
    c.add_argument("dir")
    c.add_argument("--glob")
    c.add_argument("--digest", action=argparse.BooleanOptionalAction, default=True, help="compare contents (default), or only length and time")
    c.add_argument("--previous")
    c.add_argument("--save")
    w = sub.add_parser("crawl", help="tables below a lake root: compatible files grouped")
    w.add_argument("root")
    w.add_argument("--glob", default="*.parquet")
    w.add_argument("--similarity", type=float, default=0.7)
    t = sub.add_parser("partitions", help="key=value folders of a location against the catalog's partitions")
    t.add_argument("table")
    t.add_argument("location")
    t.add_argument("--repair", action="store_true")
    t.add_argument("--principal")
    t.add_argument("--lake-root", default="lake")
    m = sub.add_parser("split", help="CSV rows kept and rows quarantined, as Parquet")
    m.add_argument("path")
    m.add_argument("--kept", required=True)
    m.add_argument("--quarantined", required=True)
    m.add_argument("--unquoted", action="store_true")
    n = sub.add_parser("reconcile", help="key ranges in which two Parquet tables differ")
    n.add_argument("left")
    n.add_argument("right")
    n.add_argument("--key", required=True)
    n.add_argument("--leaf", type=int, default=1)
    y = sub.add_parser("lineage", help="source columns of each output column of a file's statements")
    y.add_argument("file")
    y.add_argument("--sales", required=True)
    y.add_argument("--employees", required=True)
    y.add_argument("--principal", default=ANALYTICS)
    for p in (s, e, q, x, v, r, d, c, w, t, m, n, y):
        p.add_argument("--master")
    args = ap.parse_args(argv)
    spark = get_session(args.master)

    if args.cmd == "sales":
        df = sales_by_category(read_raw_csv(spark, args.items), read_raw_csv(spark, args.products))
        _publish(spark, df, SALES_CONTRACT, args.output, args.lake_root)
        return 0
    if args.cmd == "employees":
        raw = read_raw_csv(spark, args.sheet, quoted=False)
        for r in conformance_report(raw).collect():  # one row per sheet column
            print(f"{r.column} <- {r.source} ({r.status})", file=sys.stderr)
        df = conform_employees(raw, load_date_value=args.load_date)
        _publish(spark, df, EMPLOYEE_CONTRACT, args.output, args.lake_root)
        return 0

    if args.cmd == "discover":
        nested = args.location is not None
        found = C.discover_schema(spark, args.path, args.glob, nested=nested)
        _print_all(found.orderBy("position", "column").select("column", "type", "files", "status"))
        if args.table:
            declared = C.schema_frame(spark, spark.table(args.table).schema, nested=nested)
            drift = C.schema_drift(declared, found.select("column", "type"), args.table)
            _print_all(drift.orderBy("column"))
            if args.apply:
                policy = G.Policy(G.reference_grants(args.lake_root))
                if not args.principal and args.table.split(".")[0] in {g.database for g in policy.grants}:
                    ap.error("--apply to a governed database needs --principal, whose DDL grants are checked")
                allowed = policy.ddl_guard(args.principal) if args.principal else None
                if nested:
                    print(C.evolve_table(spark, args.table, args.location, drift, allowed=allowed).toDDL())
                    return 0
                for stmt in C.apply_drift(spark, args.table, drift, allowed=allowed):
                    print(stmt)
        return 0
    if args.cmd == "changes":
        if args.save and args.previous and args.save.rstrip("/") == args.previous.rstrip("/"):
            ap.error("--save must differ from --previous (keep one manifest per delivery)")
        current = M.raw_file_manifest(spark, args.dir, glob=args.glob, with_md5=args.digest)
        if args.previous:
            _print_all(M.changed_files(current, spark.read.parquet(args.previous)).orderBy("path"))
        else:
            _print_all(current.orderBy("path"))
        if args.save:
            current.write.mode("overwrite").parquet(args.save)
        return 0
    if args.cmd == "crawl":
        _print_all(W.crawl(spark, args.root, args.glob, args.similarity).select("table", "location", "folders", "files", "rows", "columns", "status", "schema").orderBy("location", "table"))
        return 0
    if args.cmd == "partitions":
        if args.repair:
            policy = G.Policy(G.reference_grants(args.lake_root))
            if not args.principal and args.table.split(".")[0] in {g.database for g in policy.grants}:
                ap.error("--repair in a governed database needs --principal, whose DDL grants are checked")
            allowed = policy.ddl_guard(args.principal) if args.principal else None
            done = W.repair_partitions(spark, args.table, args.location, allowed=allowed)
            print(f"added {done['MISSING']}, dropped {done['STALE']}", file=sys.stderr)
        _print_all(W.partition_report(spark, args.table, args.location).orderBy("spec"))
        return 0
    if args.cmd == "split":
        split = split_csv(spark, args.path, quoted=not args.unquoted)
        split.kept.write.parquet(args.kept)
        split.quarantined.write.parquet(args.quarantined)
        _print_all(split.checks)
        return 0
    if args.cmd == "reconcile":
        left, right = spark.read.parquet(args.left), spark.read.parquet(args.right)
        found = R.differing_ranges(left, right, args.key, leaf=args.leaf)
        _print_all(found.orderBy("lo"))
        return 0 if found.isEmpty() else 1
    if args.cmd == "refresh":
        out = refresh_lake(spark, args.lake_root, RawDeliveries(args.items, args.products, args.sheet), load_date=args.load_date)
        print(out.sales_path)
        print(out.employees_path)
        _print_all(out.checks.orderBy("check"))
        verdict = X.verdict(out.checks).first()
        print(f"verdict: {verdict['verdict']} (ok={verdict['ok']} fail={verdict['fail']} warn={verdict['warn']})")
        return 0 if verdict["verdict"] != "FAIL" else 1

    # Lake paths only matter for write grants, so a placeholder root is
    # enough for reading.
    policy = G.Policy(G.reference_grants("lake"))
    if args.cmd in ("sql", "lineage"):
        # The principal session exposes the governed tables; statements run one
        # by one and may name them bare or with their database.
        with open(args.file) as fh:
            statements = G.split_statements(fh.read())
        session = G.as_principal(
            spark,
            policy,
            args.principal,
            {
                SALES_CONTRACT.qualified_name: lambda sess: read_refined(sess, SALES_CONTRACT, args.sales),
                EMPLOYEE_CONTRACT.qualified_name: lambda sess: read_refined(sess, EMPLOYEE_CONTRACT, args.employees),
            },
        )
        if args.cmd == "lineage":
            for statement in statements:
                _print_all(lineage.column_lineage(session, statement, session.lk_views).orderBy("position", "table", "column"))
            return 0
        cols = {c.qualified_name: c.columns for c in (SALES_CONTRACT, EMPLOYEE_CONTRACT)}
        name = args.file.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        for i, statement in enumerate(statements, 1):
            result = G.run_as(session, policy, args.principal, statement, cols)
            if args.results:
                query_id = name if len(statements) == 1 else f"{name}_{i}"
                print(K.save_result(result, args.results, query_id, args.run_date), file=sys.stderr)
            _print_preview(result)
        return 0
    sales = read_refined(spark, SALES_CONTRACT, args.sales)
    emp = read_refined(spark, EMPLOYEE_CONTRACT, args.employees)
    if args.cmd == "query":
        # the query sees the tables as the principal may (governed columns)
        sales = G.governed(sales, policy, args.principal, SALES_CONTRACT.qualified_name)
        emp = G.governed(emp, policy, args.principal, EMPLOYEE_CONTRACT.qualified_name)
        result = QUERIES[args.name](sales, emp, spark)
        if args.results:
            print(K.save_result(result, args.results, args.name, args.run_date), file=sys.stderr)
        _print_preview(result)
        return 0
    paths = dict(item.split("=", 1) for item in args.raw)
    raw = {name: read_raw_csv(spark, path) for name, path in paths.items()}
    checks = validate_lake(spark, raw, sales, emp, policy, raw_paths=paths)
    _print_all(checks.orderBy("check"))
    verdict = X.verdict(checks).first()
    print(f"verdict: {verdict['verdict']} (ok={verdict['ok']} fail={verdict['fail']} warn={verdict['warn']})")
    return 0 if verdict["verdict"] != "FAIL" else 1


if __name__ == "__main__":
    sys.exit(main())
