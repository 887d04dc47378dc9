"""`python -m lectern QUERY TABLES [OUT]`: runs a registered query and shows or writes its rows."""

import sys

from .plans.registry import QUERIES
from .session import session

if __name__ == "__main__":
    if len(sys.argv) < 3 or sys.argv[1] not in QUERIES:
        sys.exit(f"{__doc__}\n" + "\n".join(sorted(QUERIES)))
    found = QUERIES[sys.argv[1]](session(), sys.argv[2])
    found.write.parquet(sys.argv[3]) if len(sys.argv) > 3 else found.show(50, truncate=80)
