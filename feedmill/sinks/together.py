"""Several outputs written at a time, and shown all or not at all.

Every output is first written to a hidden folder beside the final ones, by a bounded
number of Spark jobs at a time. The first failure cancels the others and nothing is
shown. When all are whole, a journal names the moves; from then on the outputs are
decided, and a driver that dies between two moves leaves the rest to ``recover``,
which the next call runs first. While a journal stands, the outputs it names may be
incomplete. On an object store a move copies the files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, Future, ThreadPoolExecutor, wait

from pyspark.sql import SparkSession

from feedmill.stores import create_json, delete, exists, place, read_json

_STAGED = ".staged-"
_JOURNAL = "_moves-"

#: Called as ``step(name, path)`` when the journal is ``decided`` and when a path is ``moved``.
Step = Callable[[str, str], None]


def run_jobs(spark: SparkSession, tasks: list[Callable[[], object]], jobs: int) -> list:
    """Results of tasks that start Spark jobs, ``jobs`` at a time; the first failure cancels all others and is raised."""
    context, tag = spark.sparkContext, f"together-{uuid.uuid4().hex}"

    def tagged(task: Callable[[], object]) -> object:
        context.addJobTag(tag)
        try:
            return task()
        finally:
            context.removeJobTag(tag)

    with ThreadPoolExecutor(max(1, jobs)) as pool:
        futures: list[Future] = [pool.submit(tagged, task) for task in tasks]
        done, waiting = wait(futures, return_when=FIRST_EXCEPTION)
        failed = next((f for f in futures if f in done and not f.cancelled() and f.exception()), None)
        if failed is not None:
            for future in waiting:
                future.cancel()
            # A task may be between two jobs: what it starts after this is cancelled in the next turn.
            while waiting:
                context.cancelJobsWithTag(tag)
                _, waiting = wait(waiting, timeout=0.5)
            raise failed.exception()
    return [f.result() for f in futures]


def _moves(spark: SparkSession, folder: str, journal: str, step: Step) -> None:
    """Do the moves of a journal that are left, then drop it and the hidden folder."""
    record = read_json(spark, journal)
    for old, new in record["moves"]:
        source, store = place(spark, f"{folder}/{old}")
        target, _ = place(spark, f"{folder}/{new}")
        # A source that is gone was moved before the driver died.
        if store.exists(source):
            if store.exists(target):
                store.delete(target, True)
            if not store.rename(source, target):
                raise OSError(f"{folder}/{old} cannot be moved to {new}; recover() goes on from {journal}")
        step("moved", new)
    delete(spark, f"{folder}/{record['staged']}")
    delete(spark, journal)


def recover(spark: SparkSession, folder: str) -> int:
    """Finish what a driver that died had decided; how many journals were left.

    A journal that was cut short decided nothing: it and its hidden folder go. Not to be
    called while another driver shows outputs in the same folder.
    """
    there, store = place(spark, folder)
    if not store.exists(there):
        return 0
    names = [s.getPath().getName() for s in store.listStatus(there)]
    journals = [n for n in names if n.startswith(_JOURNAL) and n.endswith(".json")]
    for name in journals:
        if read_json(spark, f"{folder}/{name}") is None:
            delete(spark, f"{folder}/{_STAGED}{name.removeprefix(_JOURNAL).removesuffix('.json')}")
            delete(spark, f"{folder}/{name}")
        else:
            _moves(spark, folder, f"{folder}/{name}", lambda step, path: None)
    return len(journals)


def write_together(
    spark: SparkSession,
    folder: str,
    writes: dict[str, Callable[[str], object]],
    jobs: int = 4,
    overwrite: bool = False,
    step: Step = lambda name, path: None,
) -> list[str]:
    """Write ``folder/<name>`` for every name, by ``writes[name](path)``; gives the paths.

    All outputs appear, or none does. One that is there already stops the call before
    anything is written, or with ``overwrite`` is replaced once all new ones are whole.
    ``step`` is told how far the moves are, and may stop them by raising.
    """
    folder = folder.rstrip("/")
    recover(spark, folder)
    paths = [f"{folder}/{name}" for name in writes]

    def free() -> None:
        if not overwrite and (taken := [p for p in paths if exists(spark, p)]):
            raise FileExistsError(f"already there: {', '.join(taken)}")

    free()
    number = uuid.uuid4().hex
    staged, journal = f"{_STAGED}{number}", f"{folder}/{_JOURNAL}{number}.json"

    def task(name: str, write: Callable[[str], object]) -> Callable[[], object]:
        return lambda: write(f"{folder}/{staged}/{name}")

    try:
        run_jobs(spark, [task(name, write) for name, write in writes.items()], jobs)
        free()
    except BaseException:
        delete(spark, f"{folder}/{staged}")
        raise
    create_json(spark, journal, {"staged": staged, "moves": [[f"{staged}/{name}", name] for name in writes]})
    step("decided", journal)
    _moves(spark, folder, journal, step)
    return paths
