"""Command line: repositories of input files against captured tables."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import functions as F

from forgelake.config import PRESETS, EngineConfig, preset
from forgelake.errors import SettingError
from forgelake.plans import pipeline
from forgelake.session import local_session
from forgelake.sources import records, sinks


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="forgelake", description=__doc__)
    p.add_argument("-i", "--input", action="append", required=True, help="input file (repeatable)")
    p.add_argument("-s", "--stars", type=int, default=1000, help="least stars")
    p.add_argument("-o", "--output", default="output", help="output folder")
    p.add_argument("--tables", help="folder of stats, pulls and commits (Parquet)")
    p.add_argument("--preset", choices=sorted(PRESETS), help="named settings")
    p.add_argument("--max-closed-prs", type=int, help="closed requests per repository")
    p.add_argument("--skip-commits", action="store_true")
    p.add_argument("--dry-run", action="store_true", help="only show what would be done")
    p.add_argument("-w", "--cores", default="*", help="cores of a local run")
    p.add_argument("--asof", default="1970-01-01T00:00:00", help="time written into the records")
    return p.parse_args(argv)


def settings(a: argparse.Namespace) -> EngineConfig:
    given = {"min_stars": a.stars, "with_commits": not a.skip_commits}
    if a.max_closed_prs is not None:
        if a.max_closed_prs < 0:
            raise SettingError("--max-closed-prs must not be negative")
        given["closed_limit"] = a.max_closed_prs
    return preset(a.preset, **given) if a.preset else EngineConfig(**given)


def main(argv: list[str] | None = None) -> int:
    a = arguments(argv)
    config = settings(a)
    spark = local_session(a.cores)
    paths = records.usable_paths(a.input)
    if not paths:
        print("no input file can be read")
        return 1
    repos = records.repositories(records.read_inputs(spark, paths)).groupBy("url").agg(F.max("stars").alias("stars"), F.max("language").alias("language"))
    done = records.known_urls(spark, a.output) if list(Path(a.output).glob("*.jsonl")) else spark.createDataFrame([], "url string")
    if a.dry_run or not a.tables:
        pipeline.dry_run(repos, done, config).show(truncate=False)
        return 0
    stats, pulls, commits = (spark.read.parquet(f"{a.tables}/{t}.parquet") for t in ("stats", "pulls", "commits"))
    out = pipeline.output_records(pipeline.to_do(repos, done, config), stats, pulls, commits, config, a.asof)
    sinks.write_records(out, f"{a.output}/{sinks.output_name(Path(paths[0]).stem, config.min_stars)}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
