"""Write PLANS.md: the physical plan of every registered query at cluster scale.

Automatic broadcasts are switched off, as they would be for tables far
above the broadcast threshold, so the plans show the shuffles a large run
performs.  Explicit broadcasts (bounded by construction or by a count)
stay.  Usage: python tools/dump_plans.py [SF_DIR] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from revlens.plans import catalog  # noqa: E402
from revlens.session import local_session  # noqa: E402

CTRL = "".join(chr(i) for i in range(0x21))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print("# Physical plans at cluster scale\n")
    print("Generated by `tools/dump_plans.py` with automatic broadcasts off and AQE off, "
          "i.e. the static shape for tables far above the broadcast threshold. At runtime "
          "AQE may still turn a join whose side proves small into a broadcast, split skewed "
          "join partitions and coalesce small shuffle partitions.\n")
    for name, fn in catalog.queries().items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf_dir).explain("simple")
        text = re.sub(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/", "Location: [",
                      buf.getvalue().strip())
        text = re.sub(r"#\d+L?", "", text)
        text = text.replace(CTRL, "<U+0000..U+0020>")
        text = re.sub(r"[\x00-\x08\x0b-\x1f]", lambda m: f"\\x{ord(m.group()):02x}", text)
        lines = text.splitlines()
        shuffles = sum(1 for ln in lines if re.search(r"(^|[-:] )Exchange ", ln)
                       and "ReusedExchange" not in ln)
        broadcasts = sum(1 for ln in lines if "BroadcastExchange" in ln)
        reused = sum(1 for ln in lines if "ReusedExchange" in ln)
        print(f"## {name}\n\nShuffle exchanges: {shuffles}; broadcast exchanges: {broadcasts}; "
              f"reused exchanges: {reused}\n\n```\n{text}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
