"""python -m corpusloom list | run QUERY SF_DIR [OUTPUT] | sql QUERY"""

from __future__ import annotations

import sys

from corpusloom.queries import ORACLE_SQL, QUERIES
from corpusloom.session import importable, session


def main(args: list[str]) -> int:
    if args[:1] == ["list"]:
        print("\n".join(sorted(QUERIES)))
    elif args[:1] == ["sql"] and len(args) == 2 and args[1] in QUERIES:
        print(ORACLE_SQL.get(args[1], "-- not expressed in SQL"))
    elif args[:1] == ["run"] and len(args) in (3, 4) and args[1] in QUERIES:
        spark = session()
        importable(spark)
        out = QUERIES[args[1]](spark, args[2])
        if len(args) == 4:
            out.write.mode("errorifexists").parquet(args[3])
        else:
            out.show(20, truncate=60)
    else:
        print(__doc__, file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
