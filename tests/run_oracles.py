"""Command line: python -m tests.run_oracles SF_DIR [query ...]"""

from __future__ import annotations

import sys
import time
import traceback

from __spark_entry__ import oracle_sql, queries
from demandtide.session import build_session
from tests.compare import connect, difference


def main(sf_dir: str, names: list[str]) -> None:
    spark, con, sql = build_session(), connect(sf_dir), oracle_sql()
    for name, query in queries().items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            if name in sql:
                found = difference(query(spark, sf_dir), con, sql[name]) or "equal"
            else:
                found = f"no oracle, {len(query(spark, sf_dir).collect())} rows"
        except Exception as e:  # noqa: BLE001
            found = "ERROR " + str(e)[:600] + traceback.format_exc()[-300:]
        print(f"{name:34s} {time.time() - t:6.2f}s  {found}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
