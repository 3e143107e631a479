"""Run registered queries next to their SQL and compare the rows.

    python tools/check_oracles.py [sf dir] [query ...]
"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from review_lens.plans.registry import oracle_sql, queries  # noqa: E402
from review_lens.session import build_session  # noqa: E402


def rows_of(frame):
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    return columns, sorted(map(repr, plain.itertuples(index=False, name=None)))


def main(sf_dir="/root/testdata/sf0.01", *names):
    spark = build_session(
        "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    failed = []
    for name, run in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            ours = run(spark, sf_dir).toPandas()
            took = time.time() - started
            sql = oracle_sql().get(name)
            if sql is None:
                print(f"rows  {name}: {len(ours)} rows, {took:.1f} s", flush=True)
                continue
            mine, theirs = rows_of(ours), rows_of(db.execute(sql).df())
            same = mine == theirs
            verdict = "ok   " if same else "DIFF "
            print(f"{verdict} {name}: {len(mine[1])} rows, {took:.1f} s", flush=True)
            if not same:
                failed.append(name)
                print("  columns", mine[0], theirs[0], "rows", len(mine[1]), len(theirs[1]))
                for a, b in [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b][:3]:
                    print("  spark ", a[:300], "\n  duckdb", b[:300])
        except Exception as error:
            failed.append(name)
            print(f"FAIL  {name}: {str(error)[:1500]}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
