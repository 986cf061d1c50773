"""Q1: refused messages read back, corrected by rules and logged, each once.

A message is known by its position and its text. A ledger next to the lake holds those that were
replayed; what it names is left out by an anti-join, so replaying twice adds nothing.
The rows of a replay are a batch of their own, numbered by the ledger's length: a replay that
stopped before its ledger entry was written is repeated under the same number and overwrites
its rows. For event types without state (JSON, processors of the user); a KServe message's
other side has left the state by then.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from predlake.functions.shared_files import names_in
from predlake.model import ENVELOPE, QUARANTINE
from predlake.operators.schema import PinnedSchema
from predlake.plans.logger import DESTINATIONS, Logged, run_logger
from predlake.plans.spec import LoggerSpec, SpecError

KEY = ["topic", "partition", "offset", "_text"]
FIRST_BATCH = 1_000_000_000   # replays are numbered from here, beyond a stream's micro-batches
LEDGER_DDL = "topic string, partition int, offset bigint, _text bigint, outcome string"


def _known(ledger: DataFrame, messages: DataFrame) -> Column:
    same = F.lit(True)
    for c in KEY:
        same = same & messages[c].eqNullSafe(ledger[c])
    return same


def _ledger(spark: SparkSession, url: str) -> DataFrame | None:
    """What was replayed; None before the first replay."""
    try:
        return spark.read.schema(LEDGER_DDL).parquet(url)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def corrected(refused: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Refused messages of the reasons that have a rule, as envelopes with the rule's text; where it gives null or the same text, none."""
    value = F.lit(None).cast("string")
    for reason, rule in rules.items():
        value = F.when(F.col("reason") == reason, rule).otherwise(value)
    out = refused.withColumn("_new", value).where(F.col("_new").isNotNull() & ~F.col("_new").eqNullSafe(F.col("value")))
    nothing = {"key": F.lit(None).cast("binary"), "headers": F.array().cast(ENVELOPE["headers"].dataType)}
    return out.withColumn("value", F.col("_new")).withColumns(nothing).select(*ENVELOPE.names, "_text")


def replay(spark: SparkSession, spec: LoggerSpec, quarantine: str, ledger: str, rules: dict[str, Column], schema: PinnedSchema) -> int:
    """Log what ``rules`` mend of the messages refused under ``quarantine``; the number of messages replayed.

    A rule is an expression over ``value``, by reason. A message that is refused again stays in the quarantine and is not
    tried again by the same text. Copies at one position with one text are one message.
    """
    if spec.events.type == "kserve":
        raise SpecError("a paired event has no state left to be replayed in")
    number = FIRST_BATCH + len([n for n in names_in(spark, ledger) if n.startswith("replay=")])
    refused = spark.read.schema(QUARANTINE).parquet(quarantine).withColumn("_text", F.xxhash64("value"))
    done = _ledger(spark, ledger)
    if done is not None:  # before copies are told apart: what is left to sort is new
        refused = refused.join(done, _known(done, refused), "left_anti")
    fixed = corrected(refused.dropDuplicates(KEY), rules).persist()
    try:
        n = fixed.count()
        if not n:
            return 0
        logged: Logged = run_logger(spec, fixed.drop("_text"), schema=schema)
        DESTINATIONS[spec.destination.type](logged.good, {**spec.destination.config, "batch": number}, spec.name)
        # a message that is refused again has one row, with a reason
        again = logged.quarantine.select(*[F.col(c).alias(f"_{c}") for c in KEY[:3]], "reason").dropDuplicates()
        same = F.lit(True)
        for c in KEY[:3]:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        (fixed.select(*KEY).join(again, same, "left").select(*KEY, F.coalesce("reason", F.lit("logged")).alias("outcome"))
         .write.mode("overwrite").parquet(f"{ledger}/replay={number}"))
        return n
    finally:
        fixed.unpersist()
