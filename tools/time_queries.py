"""Time every registered query over a folder: full results written to the no-op sink.

usage: time_queries.py [folder] [name part ...]
"""

from __future__ import annotations

import sys
import time

from check_oracles import entry, session

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = session()
    total = 0.0
    for name, run in entry.queries().items():
        if sys.argv[2:] and not any(name.startswith(p) for p in sys.argv[2:]):
            continue
        started = time.monotonic()
        run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds = time.monotonic() - started
        total += seconds
        print(f"{name:42s} {seconds:6.2f}s", flush=True)
    print(f"{total:.1f}s")
