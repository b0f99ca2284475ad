"""Jobs that do not wait for one another, submitted at the same time."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from graphlib import TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

AT_ONCE = 8

#: Writes by name: the names of those they build on, and what writes them.
Graph = Mapping[str, tuple[Sequence[str], Callable[[], DataFrame]]]


def run_graph(spark: SparkSession, graph: Graph, *, at_once: int = AT_ONCE) -> dict[str, DataFrame]:
    """Run writes as soon as those they build on are done, independent ones at the same time.

    The first failure is raised after the writes under way have ended; none is started after it.
    """
    order = TopologicalSorter({name: needs for name, (needs, _) in graph.items()})
    order.prepare()
    done: dict[str, DataFrame] = {}
    with ThreadPoolExecutor(at_once) as pool:
        running = {}
        while order.is_active():
            for name in order.get_ready():
                running[pool.submit(inheritable_thread_target(spark)(graph[name][1]))] = name
            ended, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in ended:
                name = running.pop(future)
                done[name] = future.result()
                order.done(name)
    return done


def run_together(spark: SparkSession, jobs: Sequence[Callable[[], DataFrame]]) -> list[DataFrame]:
    """The results of independent jobs, in their order."""
    done = run_graph(spark, {str(k): ((), job) for k, job in enumerate(jobs)})
    return [done[str(k)] for k in range(len(jobs))]
