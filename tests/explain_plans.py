"""Write ``explain("formatted")`` of every registered query to a folder.

Usage: python tests/explain_plans.py OUT_DIR [sf_dir] [query ...]
Model-fitting queries run their fits while the DataFrame is built.
"""

from __future__ import annotations

import io
import os
import sys
from contextlib import redirect_stdout

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    out_dir = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.001"
    from carepath.session import get_session
    import __spark_entry__ as e
    spark = get_session("local[8]", shuffle_partitions=8)
    os.makedirs(out_dir, exist_ok=True)
    qs = e.queries()
    for name in sys.argv[3:] or sorted(qs):
        buf = io.StringIO()
        with redirect_stdout(buf):
            qs[name](spark, sf_dir).explain("formatted")
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(buf.getvalue())
        print(name)


if __name__ == "__main__":
    main()
