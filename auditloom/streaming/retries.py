"""Attempts at tasks, each with what the one before taught: as a stream with state, and as a batch (T-11).

A result that ran out of turns is tried again with half as many turns more, rounded up; one over its budget
ends the task; any other failure, and a success that lacks files, is tried again with the reason; the last of
``attempts`` ends the task in any case. The stream keeps a task's number of results, turns and whether it ended in
one value of state; results after the end change nothing. The batch needs no state: turns follow from how
many results before ran out of them.

Streams with state need the RocksDB provider (``spark.sql.streaming.stateStore.providerClass``).

Defined results: a null status is a failure; null files are none; results of a task go by ``at``, and ties by
status; a task without a result has no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Statuses of results, and what a further attempt is told.
SUCCESS, OUT_OF_TURNS, OVER_BUDGET = "success", "error_max_turns", "error_max_budget_usd"
TOLD_TURNS = "Agent exhausted the turn limit ({} turns)."
TOLD_STATUS = "Agent returned status '{}'. Output: {}"
TOLD_FILES = "Agent reported success but the following required output files are missing: {}"
AMENDED = "\n\nIMPORTANT: A previous attempt (attempt {}) failed. Here is what went wrong:\n{}\nPlease avoid the same mistake and try again."

STEP = "task_id string, attempt int, max_turns int, status string, decision string, next_turns int, reason string"


def turns_after(first: int, times: int) -> int:
    """The limit after so many results that ran out of turns."""
    for _ in range(times):
        first = math.ceil(first * 1.5)
    return first


def decided(attempt: Column, turns: Column, more: Column, status: Column, output: Column, missing: Column, attempts: int) -> list[Column]:
    """decision, next_turns and reason of a result: done, over budget, retry or gave up."""
    status, lacks = F.coalesce(status, F.lit("")), F.coalesce(missing, F.array().cast("array<string>"))
    names = F.concat(F.lit("["), F.array_join(F.transform(lacks, lambda f: F.concat(F.lit("'"), f, F.lit("'"))), ", "), F.lit("]"))
    fill = lambda form, *parts: F.concat(*[x for pair in zip(form.split("{}"), [*parts, F.lit("")], strict=True) for x in (F.lit(pair[0]), pair[1])])
    reason = F.when(status == OUT_OF_TURNS, fill(TOLD_TURNS, turns.cast("string"))).when(status != SUCCESS, fill(TOLD_STATUS, status, F.coalesce(F.nullif(output, F.lit("")), F.lit("(none)")))).when(F.size(lacks) > 0, fill(TOLD_FILES, names))
    decision = F.when(status == OVER_BUDGET, "over budget").when(reason.isNull(), "done").when(attempt >= attempts, "gave up").otherwise("retry")
    return [decision.alias("decision"), F.when(decision == "retry", F.when(status == OUT_OF_TURNS, more).otherwise(turns)).alias("next_turns"), F.when(decision == "retry", reason).alias("reason")]


def amended(prompt: Column, attempt: Column, reason: Column) -> Column:
    """The prompt for the attempt after this one."""
    head, middle, tail = AMENDED.split("{}")
    return F.when(reason.isNull(), prompt).otherwise(F.concat(prompt, F.lit(head), attempt.cast("string"), F.lit(middle), reason, F.lit(tail)))


def steps(results: DataFrame, turns: int = 50, attempts: int = 3) -> DataFrame:
    """STEP of results (task_id, at, status, output, missing) up to each task's end."""
    w = Window.partitionBy("task_id").orderBy("at", "status")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    limits = F.array(*[F.lit(turns_after(turns, k)) for k in range(attempts + 1)])
    at = F.least(F.coalesce(F.sum((F.coalesce("status", F.lit("")) == OUT_OF_TURNS).cast("int")).over(before), F.lit(0)), F.lit(attempts - 1)).cast("int")
    rows = results.withColumn("attempt", F.row_number().over(w)).withColumn("_at", at).where(F.col("attempt") <= attempts)
    rows = rows.withColumn("max_turns", F.get(limits, F.col("_at"))).withColumn("_more", F.get(limits, F.col("_at") + 1))
    rows = rows.select("task_id", "at", "attempt", "max_turns", "status", *decided(F.col("attempt"), F.col("max_turns"), F.col("_more"), F.col("status"), F.col("output"), F.col("missing"), attempts))
    over = F.max((F.col("decision") != "retry").cast("int")).over(before)
    return rows.withColumn("_over", F.coalesce(over, F.lit(0))).where("_over = 0").select("task_id", "attempt", "max_turns", "status", "decision", "next_turns", "reason")


class Attempts(StatefulProcessor):
    """A task's results as they come, to STEP."""

    def __init__(self, turns: int, attempts: int):
        self.turns, self.attempts = turns, attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("task", "seen int, turns int, ended boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen, turns, ended = self.state.get() if self.state.exists() else (0, self.turns, False)
        for r in sorted(rows, key=lambda r: (r.at, r.status or "")):
            if ended:
                break
            seen, status, used, reason = seen + 1, r.status or "", turns, None
            if status == OUT_OF_TURNS:
                reason, turns = TOLD_TURNS.format(turns), math.ceil(turns * 1.5)
            elif status != SUCCESS:
                reason = TOLD_STATUS.format(status, r.output or "(none)")
            elif r.missing:
                reason = TOLD_FILES.format("[" + ", ".join(f"'{f}'" for f in r.missing) + "]")
            decision = "over budget" if status == OVER_BUDGET else "done" if reason is None else "gave up" if seen >= self.attempts else "retry"
            ended = decision != "retry"
            yield Row(task_id=key[0], attempt=seen, max_turns=used, status=r.status, decision=decision, next_turns=None if ended else turns, reason=None if ended else reason)
        self.state.update((seen, turns, ended))

    def close(self) -> None:
        pass


def retried(results: DataFrame, turns: int = 50, attempts: int = 3) -> DataFrame:
    """steps() of a stream of results."""
    return results.groupBy("task_id").transformWithState(Attempts(turns, attempts), STEP, "Update", "None")
