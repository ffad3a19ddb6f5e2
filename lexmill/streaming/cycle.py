"""The continuous cycle: every arriving batch of texts, probes or payloads drives the jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.plans import batches, jobs
from lexmill.schemas import TABLES
from lexmill.sources.tables import Change, StateTables
from lexmill.streaming.logs import BatchLog

EXTRACTION_SCHEMA = (
    "document_id string, type string, year int, number long, json string, confidence double, "
    "source string, n_articles int, unknown_words array<string>"
)


def extract_stream(
    texts: DataFrame,
    dictionary: DataFrame,
    log: BatchLog,
    checkpoint: str,
    as_of: str,
    options: jobs.ExtractOptions = jobs.ExtractOptions(),
    **trigger,
):
    """Extract texts as they arrive. Keeping the better result is associative, so each batch just
    appends its rows and `best_extractions` merges them on read."""

    def step(batch: DataFrame, batch_id: int) -> None:
        log.write(jobs.extract_documents(batch, dictionary, as_of, options), batch_id)

    return (
        texts.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def best_extractions(log: BatchLog) -> DataFrame:
    """Highest confidence per document; the earlier batch wins a tie."""
    return log.best(["document_id"], [F.col("confidence"), -F.col("batch")])


def due_today(state: DataFrame, job: str, today: str) -> bool:
    """Whether a once-per-day job has not run yet today; `state` has job, day."""
    return state.where((F.col("job") == job) & (F.col("day") == today)).isEmpty()


Step = tuple[str, Callable[[StateTables], dict[str, Change | DataFrame]]]


def run_cycle(store: StateTables, steps: list[Step], version: int | None = None, today: str | None = None) -> dict[str, str]:
    """Run the steps in order and carry out what they return; a failing step does not stop the rest.

    A step reads what the steps before it wrote. With a `version`, such as the number of a
    micro-batch, a step that has ended for it is not run again. Steps whose name begins with "daily-"
    run once for each `today`. Returns the outcome per step: "ok", "not due", "done before" or the
    error text.
    """
    outcome: dict[str, str] = {}
    done = set()
    if version is not None:
        done = {r["step"] for r in store.read("cycle_steps").where(F.col("version") == version).collect()}
    for name, step in steps:
        daily = name.startswith("daily-") and today is not None
        if name in done:
            outcome[name] = "done before"
            continue
        if daily and not due_today(store.read("daily_runs"), name, today):
            outcome[name] = "not due"
            continue
        try:
            store.apply(step(store))
            if daily:
                others = store.read("daily_runs").where(F.col("job") != name)
                store.write("daily_runs", others.unionByName(store.spark.createDataFrame([(name, today)], TABLES["daily_runs"])))
            if version is not None:  # of the version under way only, so the table stays small
                done.add(name)
                store.write("cycle_steps", store.spark.createDataFrame([(version, n) for n in sorted(done)], TABLES["cycle_steps"]))
            outcome[name] = "ok"
        except Exception as error:  # isolated like any other bad input; reported to the caller
            outcome[name] = f"{type(error).__name__}: {error}"
    return outcome


def default_steps(
    feeds: dict[str, DataFrame],
    as_of: str,
    fetch: jobs.FetchOptions = jobs.FetchOptions(),
    extract: jobs.ExtractOptions = jobs.ExtractOptions(),
    fetch_current: bool = True,
) -> list[Step]:
    """The six jobs in order; `feeds` has probe_results, payloads, texts, inventory, dictionary.

    The current year is fetched once a day.
    """

    def fetch_step(mode: str):
        options = jobs.FetchOptions(**{**fetch.__dict__, "mode": mode})
        return lambda s: batches.fetch(s, feeds["probe_results"], as_of, options)

    steps = [("daily-fetch-current", fetch_step("current"))] if fetch_current else []
    return steps + [
        ("fetch-previous", fetch_step("previous")),
        ("download", lambda s: batches.download(s, feeds["inventory"], feeds["payloads"], as_of)),
        ("extract", lambda s: batches.extract(s, feeds["texts"], feeds["dictionary"], as_of, extract)),
        ("consolidate", lambda s: batches.consolidate(s, as_of)),
        ("fix", lambda s: batches.fix(s, feeds["inventory"], route_inconsistent=True)),
    ]


def start_cycle(arrivals: DataFrame, cycle: Callable[[DataFrame, int], None], checkpoint: str, **trigger):
    """Run `cycle(batch, batch_id)` for every arriving batch; 5 seconds apart unless told otherwise."""
    return (
        arrivals.writeStream.foreachBatch(cycle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
