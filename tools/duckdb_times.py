"""DuckDB times for the bench queries on the same files, median of three.

``prepared`` reads star tables made beforehand, as the Spark queries do; ``whole`` builds
the star inside each query.

    python tools/duckdb_times.py [folder] [threads]
"""

import json
import statistics
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from bench import HEADLINE  # noqa: E402
from oracle import sheets, star  # noqa: E402


def seconds(db, sql, runs=3):
    spent = []
    for _ in range(runs):
        start = time.perf_counter()
        db.execute(sql).fetchall()
        spent.append(time.perf_counter() - start)
    return round(statistics.median(spent), 3)


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = sys.argv[2] if len(sys.argv) > 2 else "8"
    db = duckdb.connect(config={"threads": threads})
    for path in Path(folder).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    out = {"whole": {}, "prepared": {}}
    start = time.perf_counter()
    for name in ("ses", "ser", "de", "df", "dp", "fact", "wide"):
        db.execute(f"CREATE TABLE star_{name} AS WITH {star.STAR} SELECT * FROM {name}")
    out["build_star"] = round(time.perf_counter() - start, 3)
    tables = ", ".join(f"{n} AS (SELECT * FROM star_{n})" for n in ("ses", "ser", "de", "df", "dp", "fact", "wide"))
    for name in HEADLINE:
        sql = {**star.SQL, **sheets.SQL}[name]
        out["whole"][name] = seconds(db, sql)
        for prefix in (star.STAR, star.BRONZE):
            if name in star.SQL and sql.startswith(f"WITH {prefix}"):
                out["prepared"][name] = seconds(db, f"WITH {tables}{sql[len('WITH ' + prefix):]}")
                break
    print(json.dumps(out))


if __name__ == "__main__":
    main()
