"""The job edge: read a layer, run a plan, write the next layer.

Each step is one command, so any scheduler can run them in order::

    python -m tablewright.plans.jobs ingest --raw R --bronze B
    python -m tablewright.plans.jobs clean --bronze B --silver S
    python -m tablewright.plans.jobs features --silver S --gold G --vocab V
    python -m tablewright.plans.jobs gate --gold G
    python -m tablewright.plans.jobs apply --gold G
    python -m tablewright.plans.jobs materialize --gold G --online O --until T
    python -m tablewright.plans.jobs train --gold G --labels L --label churn --time T --model M

``all`` runs them in this order under one root folder. A step that fails ends
with exit code 1. Every write is one Spark job; row counts come from the write
itself. ``--input-bytes`` sizes shuffles and scans for an input of that size.
"""

from __future__ import annotations

import argparse
import logging
import sys
import uuid
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.naming import quoted
from tablewright.operators.cleaning import ROWS_READ, standardise
from tablewright.operators.dedup import dedup_by_key, dedup_rare
from tablewright.operators.encoding import extend_vocab, fit_vocab
from tablewright.operators.quality import GateFailed, coercion_rules, enforce_gate, run_gate
from tablewright.operators.refresh import refresh_buckets, store_of
from tablewright.operators.serving import (
    materialize_incremental,
    materialize_latest,
    point_in_time_join,
)
from tablewright.operators.training import train_eval
from tablewright.operators.views import conform, view_mismatches
from tablewright.plans import customer, layers
from tablewright.session import build_session, sizing_conf, through_storage
from tablewright.sources import (
    current_snapshot,
    ingest_quarantined,
    publish_snapshot,
    read_table,
    read_tabular,
    write_counted,
    write_table,
)
from tablewright.sources.files import kept_rows

log = logging.getLogger("tablewright")


def ingest(
    spark: SparkSession,
    raw: str,
    bronze: str,
    *,
    raw_format="csv",
    schema: str | None = None,
    table_format="parquet",
) -> int:
    """Raw file to bronze, names as they are; types are inferred unless a
    ``schema`` saves that extra read."""
    rows = write_counted(read_tabular(spark, raw, raw_format, schema), bronze, table_format)
    log.info("bronze: %d rows", rows)
    return rows


def ingest_sorted(
    spark: SparkSession,
    raw: str,
    landing: str,
    bronze: str,
    *,
    raw_format="csv",
    schema: str | None = None,
    table_format="parquet",
    max_quarantined: int | None = None,
) -> dict[str, int]:
    """Raw file to bronze, with rows that do not fit the schema set aside under
    ``landing``; types come from the first lines unless a ``schema`` is given.
    More than ``max_quarantined`` such rows fail the job before bronze is written."""
    counts = ingest_quarantined(spark, raw, landing, raw_format, schema, table_format=table_format)
    log.info("landing: %(read)d rows read, %(kept)d kept, %(quarantined)d quarantined", counts)
    if max_quarantined is not None and counts["quarantined"] > max_quarantined:
        raise GateFailed([f"quarantine: {counts['quarantined']} rows do not fit the schema"])
    write_table(kept_rows(spark, landing, table_format), bronze, table_format)
    return counts


def clean(
    spark: SparkSession,
    bronze: str,
    silver: str,
    spec=customer.CLEAN,
    *,
    table_format="parquet",
    few_duplicates: bool = False,
    max_coerced: int | None = None,
) -> tuple[int | None, int]:
    """Bronze to silver in one write; returns rows read and rows kept.
    ``few_duplicates`` picks the dedup that shuffles only repeated keys; it
    reads bronze more than once, so neither the rows read nor the values lost are
    counted. With ``max_coerced`` the job fails if cleaning turned more values of
    a column into NULL; they are counted by the write itself."""
    before, after = Observation(), Observation()
    counter = F.count(F.lit(1)).alias("n")
    source = read_table(spark, bronze, table_format)
    if few_duplicates and max_coerced is not None:
        raise ValueError("lost values are not counted with few_duplicates")
    if few_duplicates:
        kept = dedup_rare(standardise(source, spec), spec.keys, spec.order_by)
        rows = write_counted(kept, silver, table_format)
        log.info("silver: %d rows", rows)
        return None, rows
    kept = dedup_by_key(standardise(source, spec, before), spec.keys, spec.order_by).observe(after, counter)
    write_table(kept, silver, table_format)
    lost, written = dict(before.get), after.get["n"]
    read = lost.pop(ROWS_READ)
    log.info("silver: %d rows, %d duplicates removed", written, read - written)
    for column, n in lost.items():
        if n:
            log.warning("%d values of %s became NULL", n, column)
    if max_coerced is not None:
        enforce_gate(run_gate(source.limit(0), coercion_rules(lost, max_coerced)))
    return read, written


def features(
    spark: SparkSession,
    silver: str,
    gold: str,
    spec=customer.FEATURES,
    *,
    vocab: str | None = None,
    relearn: bool = True,
    extend: str | None = None,
    as_of=None,
    table_format="parquet",
) -> int:
    """Silver to gold Parquet. With a ``vocab`` path the labels are saved
    there, or taken from there if not to be learned again. With the path of an
    earlier vocabulary in ``extend`` its slots stay and only new labels are
    added; the result is saved under ``vocab``."""
    source = read_table(spark, silver, table_format)
    labels = None
    if vocab is not None:
        if extend is not None:
            earlier = read_table(spark, extend)
            write_table(extend_vocab(earlier, source, spec.categories), vocab)
        elif relearn:
            write_table(fit_vocab(source, spec.categories, spec.max_labels), vocab)
        labels = read_table(spark, vocab)
    rows = write_counted(layers.gold(source, spec, vocab=labels, as_of=as_of), gold)
    log.info("gold: %d rows", rows)
    return rows


def gate(spark: SparkSession, gold: str, rules=None) -> list[str]:
    """Check gold in one pass; raises ``GateFailed`` with all reasons."""
    warnings = enforce_gate(run_gate(read_table(spark, gold), rules or customer.gold_rules()))
    for text in warnings:
        log.warning(text)
    log.info("gate passed")
    return warnings


def apply(spark: SparkSession, gold: str, view=None) -> None:
    """Check gold against the feature view's contract."""
    view = view or customer.feature_view(gold)
    reasons = [
        f"{r['field']}: {r['status']}, declared {r['declared']}, found {r['actual']}, "
        f"{r['lost']} values lost"
        for r in view_mismatches(read_table(spark, gold), view).collect()
    ]
    if reasons:
        raise GateFailed(reasons)
    log.info("view %s matches", view.name)


def materialize(
    spark: SparkSession,
    gold: str,
    online: str,
    until,
    view=None,
    *,
    incremental: bool = False,
    buckets: int | None = None,
) -> str:
    """Publish the latest row per key up to ``until``. The whole table is read,
    so rewritten values and rows that came late are served. ``incremental``
    reads only event times after the last publication: right for a history to
    which rows are added in the order of their event time, and only there. With
    ``buckets`` the snapshot is a bucketed store (see
    :mod:`tablewright.operators.refresh`): rows are read by event and created
    time, so late ones are served, and only buckets that change are written."""
    view = view or customer.feature_view(gold)
    if not view.online:
        raise ValueError(f"view {view.name} is not served online")
    source = conform(read_table(spark, gold), view)
    if buckets is not None:
        return refresh_buckets(store_of(online, view, buckets), source, view, until).name
    last = current_snapshot(spark, online) if incremental else None
    if last is None:
        table = materialize_latest(source, view, until)
    else:
        table = materialize_incremental(last[0], source, view, since=last[1], until=until)
    return publish_snapshot(table, online, uuid.uuid4().hex, until)


def retrieve(spark: SparkSession, gold: str, spine: DataFrame, ts: str, view=None) -> DataFrame:
    """``spine`` (keys, a time and labels) with the features of the view as of
    that time. A feature that the spine brings itself, such as the label, is
    the spine's."""
    view = view or customer.feature_view(gold)
    own = {c.lower() for c in spine.columns}
    fields = tuple(f for f in view.fields if f.name.lower() not in own)
    view = replace(view, fields=fields)
    return point_in_time_join(spine, conform(read_table(spark, gold), view), view, ts)


def train(
    spark: SparkSession, gold: str, labels: str, label: str, ts: str, model: str, view=None
) -> dict:
    """Join the stored labels with the features as of their time, fit on part
    of the keys, score on the others and save the model."""
    view = view or customer.feature_view(gold)
    spine = read_table(spark, labels).select(*map(quoted, [*view.keys, ts, label]))
    rows = through_storage(retrieve(spark, gold, spine, ts, view), "training-rows")
    inputs = [f for f in view.features if f != label]
    fitted, scored = train_eval(rows, label, view.keys, inputs)
    fitted.write().overwrite().save(model)
    result = scored.first().asDict()
    log.info("model: %s", result)
    return result


def run_all(
    spark: SparkSession,
    raw: str,
    root: str,
    until,
    *,
    raw_format="csv",
    min_rows=customer.MIN_ROWS,
    schema=None,
) -> str:
    """All steps in order; the first that fails stops the rest, so nothing
    that the gate or the contract refuses is ever served."""
    bronze, silver, gold, vocab, online = (
        f"{root.rstrip('/')}/{name}" for name in ("bronze", "silver", "gold", "vocab", "online")
    )
    ingest(spark, raw, bronze, raw_format=raw_format, schema=schema)
    clean(spark, bronze, silver)
    features(spark, silver, gold, vocab=vocab, as_of=until)
    gate(spark, gold, customer.gold_rules(min_rows))
    apply(spark, gold)
    return materialize(spark, gold, online, until)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tablewright")
    parser.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--input-bytes", type=int)
    parser.add_argument("--table-format", default="parquet")
    steps = parser.add_subparsers(dest="step", required=True)
    names = {
        "ingest": ("raw", "bronze"),
        "clean": ("bronze", "silver"),
        "features": ("silver", "gold"),
        "gate": ("gold",),
        "apply": ("gold",),
        "materialize": ("gold", "online"),
        "train": ("gold", "labels", "label", "time", "model"),
        "all": ("raw", "root"),
    }
    sub = {}
    for step, paths in names.items():
        sub[step] = steps.add_parser(step)
        for path in paths:
            sub[step].add_argument(f"--{path}", required=True)
    for step in ("ingest", "all"):
        sub[step].add_argument("--raw-format", default="csv")
    sub["ingest"].add_argument("--schema")
    sub["ingest"].add_argument("--landing")
    sub["ingest"].add_argument("--max-quarantined", type=int)
    sub["clean"].add_argument("--max-coerced", type=int)
    sub["materialize"].add_argument("--buckets", type=int)
    for step in ("gate", "all"):
        sub[step].add_argument("--min-rows", type=int, default=customer.MIN_ROWS)
    for step in ("materialize", "all"):
        sub[step].add_argument("--until")
    sub["materialize"].add_argument("--incremental", action="store_true")
    sub["all"].add_argument("--schema")
    sub["clean"].add_argument("--few-duplicates", action="store_true")
    sub["features"].add_argument("--vocab")
    sub["features"].add_argument("--keep-vocab", action="store_true")
    sub["features"].add_argument("--extend-vocab")
    sub["features"].add_argument("--as-of")
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(message)s")
    sizes = sizing_conf(args.input_bytes) if args.input_bytes else {}
    spark = build_session({**sizes, **dict(c.split("=", 1) for c in args.conf)})
    try:
        if args.step == "ingest" and args.landing:
            ingest_sorted(
                spark,
                args.raw,
                args.landing,
                args.bronze,
                raw_format=args.raw_format,
                schema=args.schema,
                table_format=args.table_format,
                max_quarantined=args.max_quarantined,
            )
        elif args.step == "ingest":
            ingest(
                spark,
                args.raw,
                args.bronze,
                raw_format=args.raw_format,
                schema=args.schema,
                table_format=args.table_format,
            )
        elif args.step == "clean":
            clean(
                spark,
                args.bronze,
                args.silver,
                table_format=args.table_format,
                few_duplicates=args.few_duplicates,
                max_coerced=args.max_coerced,
            )
        elif args.step == "features":
            features(
                spark,
                args.silver,
                args.gold,
                vocab=args.vocab,
                relearn=not args.keep_vocab,
                extend=args.extend_vocab,
                as_of=args.as_of,
                table_format=args.table_format,
            )
        elif args.step == "gate":
            gate(spark, args.gold, customer.gold_rules(args.min_rows))
        elif args.step == "apply":
            apply(spark, args.gold)
        elif args.step == "train":
            train(spark, args.gold, args.labels, args.label, args.time, args.model)
        else:
            until = args.until or datetime.now(timezone.utc).replace(tzinfo=None)
            if args.step == "materialize":
                materialize(
                    spark,
                    args.gold,
                    args.online,
                    until,
                    incremental=args.incremental,
                    buckets=args.buckets,
                )
            else:
                run_all(
                    spark,
                    args.raw,
                    args.root,
                    until,
                    raw_format=args.raw_format,
                    min_rows=args.min_rows,
                    schema=args.schema,
                )
    except GateFailed as failed:
        for reason in failed.reasons:
            log.error(reason)
        return 1
    except (PySparkException, ValueError, TypeError, RuntimeError) as error:
        log.error("%s failed: %s", args.step, error)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
