"""Command line: load collections into a catalogue, run the loop, count, clean and export results."""

from __future__ import annotations

import argparse
import functools
import importlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lumenweave", description=__doc__)
    parser.add_argument("folder", help="folder of the catalogue")
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="read collections and write the catalogue")
    load.add_argument("root")
    load.add_argument("names", nargs="+")
    generate = commands.add_parser("generate", help="claim pictures and append their results")
    generate.add_argument("--run", default="0")
    generate.add_argument("--images", type=int, default=1000)
    generate.add_argument("--distribution", default="LLaVA")
    generate.add_argument("--client", default="lumenweave.generation.model:EchoClient", help="module:factory of the model client")
    generate.add_argument("--url", help="address of a chat model, taken in place of --client")
    generate.add_argument("--model", default="default", help="name of the model at the address")
    generate.add_argument("--key-variable", help="environment variable of the executors that holds the key")
    generate.add_argument("--samples", type=int, default=10, help="most steps of a picture")
    generate.add_argument("--least", type=int, default=10, help="least characters of information")
    for name, text in (("count", "pictures and empty ones of each run"), ("stats", "conversations and messages")):
        commands.add_parser(name, help=text).add_argument("--run", default=None)
    clean = commands.add_parser("clean", help="remove results")
    clean.add_argument("--run", default=None)
    which = clean.add_mutually_exclusive_group(required=True)
    which.add_argument("--empty", action="store_true", help="only those without an output")
    which.add_argument("--all", action="store_true", help="all of the run")
    export = commands.add_parser("export", help="write conversations as JSON lines")
    export.add_argument("target")
    export.add_argument("--run", default=None)
    export.add_argument("--array", action="store_true", help="one file that is one JSON array, on this machine")
    export.add_argument("--without", nargs="*", default=[], help="prompt types to leave out")
    run(parser.parse_args(arguments))


def run(a: argparse.Namespace) -> None:
    from .generation.model import HttpClient
    from .generation.process import Settings
    from .generation.process import run as loop
    from .generation.prompts import DISTRIBUTIONS
    from .operators import results
    from .operators.catalog import Catalog, information
    from .session import ship

    spark = SparkSession.builder.getOrCreate()
    ship(spark)
    catalog = Catalog(spark, a.folder)
    if a.command == "load":
        catalog.cache(catalog.load(a.root, a.names))
        return
    if a.command == "generate":
        module, _, name = a.client.partition(":")
        factory = functools.partial(HttpClient, a.url, a.model, a.key_variable) if a.url else getattr(importlib.import_module(module), name)
        rows = catalog.reserve(a.images, a.run)
        made = loop(information(rows), factory, DISTRIBUTIONS[a.distribution], a.run, Settings(max_count=a.samples, least_information=a.least))
        results.append(made, a.folder)
        return
    stored = results.of_run(catalog.read("results", results.SCHEMA), a.run)
    if a.command == "count":
        results.count(stored, catalog.reservations(), a.run).orderBy("run_id").show(1000, False)
    elif a.command == "stats":
        results.statistics(stored).show()
    elif a.command == "clean":
        results.clean_table(catalog.read("results", results.SCHEMA), a.folder, a.run, a.empty)
    elif a.command == "export":
        good, bad = results.split_errors(stored)
        (results.write_json_array if a.array else results.write_json)(results.export(good, without=tuple(a.without)), a.target)
        bad.select("image_path", "run_id", F.col("error.type").alias("type"), F.col("error.message").alias("message")).write.mode("overwrite").json(f"{a.target}-errors")


if __name__ == "__main__":
    main()
