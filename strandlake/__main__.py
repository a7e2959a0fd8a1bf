"""Command line: ``python -m strandlake --dir_data ... --dir_out ... --path_ref ... --path_settings ...``."""

from __future__ import annotations

import argparse
from dataclasses import fields

from .plans.config import Config
from .plans.pipeline import run


def parse(argv: list[str] | None = None) -> Config:
    """Every parameter as an option; lists are comma-separated, NULL and NA stand for none, ``all`` for both mates."""
    parser = argparse.ArgumentParser(prog="strandlake")
    for f in fields(Config):
        parser.add_argument(f"--{f.name}", default=None, nargs="?", const="TRUE")
    given = {k: v for k, v in vars(parser.parse_args(argv)).items() if v is not None}
    made = {}
    for f in fields(Config):
        if f.name not in given:
            continue
        v, default = given[f.name], f.default
        if v in ("NULL", "NA") or (f.name == "select_one_of_pair" and v == "all"):
            made[f.name] = None
        elif isinstance(default, bool):
            made[f.name] = v.upper() in ("TRUE", "T", "1", "YES")
        elif isinstance(default, tuple):
            made[f.name] = tuple(type(default[0])(x.strip()) for x in v.split(","))
        elif isinstance(default, int) or f.name == "downsample":
            made[f.name] = int(v)
        elif isinstance(default, float):
            made[f.name] = float(v)
        else:
            made[f.name] = int(v) if f.name == "haplotype_trim_length" and v.isdigit() else v
    config = Config(**made)
    for need in ("dir_data", "dir_out", "path_ref"):
        if getattr(config, need) is None:
            parser.error(f"--{need} is required")
    return config


def main() -> None:
    from pyspark.sql import SparkSession

    config = parse()
    spark = SparkSession.builder.appName("strandlake").getOrCreate()
    run(spark, config)


if __name__ == "__main__":
    main()
