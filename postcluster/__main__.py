"""Cluster posting files and print the report:

    spark-submit --conf spark.checkpoint.dir=<shared folder> \\
        -m postcluster [--debug] <posting files>
    python -m postcluster --master 'local[*]' --checkpoint-dir <folder> <posting files>

The master is spark-submit's (or the cluster's default) unless given here.
Intermediate tables go to the shared folder and are gone at the end.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import dataclass

from postcluster.plans import run
from postcluster.session import checkpoint_root, discard_all, open_session


@dataclass
class Arguments:
    path: str
    debug: bool = False
    checkpoint_dir: str | None = None
    master: str | None = None


def arguments(argv: list[str]) -> Arguments:
    parser = argparse.ArgumentParser(prog="postcluster", description="cluster posting files")
    parser.add_argument("path", help="posting text files")
    parser.add_argument("--debug", action="store_true", help="print every k-means pass")
    parser.add_argument("--checkpoint-dir", help="folder that all executors share, if the session names none")
    parser.add_argument("--master", help="only where spark-submit gives none")
    return Arguments(**vars(parser.parse_args(argv)))


def main(argv: list[str]) -> int:
    args = arguments(argv)
    extra = {"spark.checkpoint.dir": args.checkpoint_dir} if args.checkpoint_dir else None
    spark = open_session(master=args.master, extra=extra)
    try:
        checkpoint_root(spark)  # an error now, not after the first scan
        run(spark, args.path, debug=args.debug)
    finally:
        discard_all(spark)
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
