"""Run one layer or all layers: `python -m rallymart all <landed> <root>`."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from rallymart.plans import layers
from rallymart.plans.registry import MARTS, export_in_display_order, run_gold
from rallymart.sources.session import configure
from rallymart.sources.tables import export_tables


def main() -> None:
    parser = argparse.ArgumentParser(prog="rallymart", description=__doc__)
    parser.add_argument("step", choices=("all", "bronze", "silver", "gold", "export"))
    parser.add_argument("landed", help="folder of landed JSON, used by all and bronze")
    parser.add_argument("root", help="folder of the stored layers")
    parser.add_argument("--arrays", action="store_true", help="landed files hold JSON arrays, not lines")
    parser.add_argument("--entities", nargs="*", help="landed entities; all in the folder if not given")
    parser.add_argument("--places", action="store_true", help="export each row's place in the display order")
    options = parser.parse_args()
    spark = configure(SparkSession.builder.appName("rallymart")).getOrCreate()
    lines, entities = not options.arrays, tuple(options.entities or ()) or None
    layer = {name: f"{options.root}/{name}" for name in ("bronze", "silver", "gold", "export")}
    steps = {
        "all": lambda: layers.run_all(spark, options.landed, options.root, lines, entities),
        "bronze": lambda: layers.run_bronze(
            spark, options.landed, layer["bronze"], lines, entities=entities
        ),
        "silver": lambda: layers.run_silver(spark, layer["bronze"], layer["silver"]),
        "gold": lambda: run_gold(
            spark, layers.stored_silver(spark, layer["silver"]), layer["gold"]
        ),
        "export": lambda: (
            export_in_display_order(spark, layer["gold"], layer["export"])
            if options.places
            else export_tables(spark, layer["gold"], layer["export"], tuple(MARTS))
        ),
    }
    for name, rows in steps[options.step]().items():
        print(f"{name}: {rows} rows")


if __name__ == "__main__":
    main()
