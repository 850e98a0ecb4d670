"""Run a job: python -m tidemark JOB DATA_FOLDER OUTPUT_FOLDER."""

from __future__ import annotations

import argparse

from tidemark.plans.jobs import JOBS, Files
from tidemark.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("data")
    parser.add_argument("out")
    args = parser.parse_args()
    spark = build_session(f"tidemark {args.job}")
    score = JOBS[args.job](Files(spark, args.data, args.out))
    if score is not None:
        for row in score.collect():
            print(row.asDict())


if __name__ == "__main__":
    main()
