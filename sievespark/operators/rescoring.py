"""Rescoring by an injected scorer, with errors as rows, resume and whole-chunk invalidation."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievespark.operators.ranking import best_per_key, ranked
from sievespark.session import cut_and_count, cut_lineage


class ScoringError(Exception):
    """What went wrong with one compound, as the text of its error column."""


def external_scorer(command: Callable[[str, str, dict], list[str]], timeout: float = 300.0, scratch: str | None = None) -> Callable[[dict], float]:
    """A scorer that runs a program for each compound, with a time limit of its own.

    ``command`` gets the paths of the record file and of the result table to be written, and the row;
    it returns the program and its arguments. The table's first row must have status S; its TOTAL is
    the score. Work is done in a folder of the worker that is removed afterwards: nothing in it is
    read by another task. Errors: ``no_output_rc<code>``, ``bad_status``, ``timeout``, ``exception``.
    """

    def score(row: dict) -> float:
        import csv
        import os
        import shutil
        import subprocess
        import tempfile

        folder = tempfile.mkdtemp(prefix=f"score_{row['compound_id'][:40]}_", dir=scratch)
        try:
            record, result = os.path.join(folder, f"{row['compound_id']}.sdf"), os.path.join(folder, "result.csv")
            with open(record, "w") as f:
                f.write(row["block"])
            try:
                run = subprocess.run(command(record, result, row), cwd=folder, capture_output=True, text=True, timeout=timeout)
            except subprocess.TimeoutExpired:
                raise TimeoutError from None
            if not os.path.isfile(result):
                raise ScoringError(f"no_output_rc{run.returncode}: {run.stderr[-300:]}")
            with open(result) as f:
                found = next(csv.DictReader(f), None)
            if found is None or found.get("status") != "S":
                raise ScoringError(f"bad_status: {found}")
            return float(found["TOTAL"])
        finally:
            shutil.rmtree(folder, ignore_errors=True)

    return score


def rescore(picks: DataFrame, scorer: Callable[[dict], float], done: DataFrame | None = None, key: Sequence[str] = ("conformation", "compound_id"), rows_per_task: int = 20) -> DataFrame:
    """``picks`` not yet in ``done``, with mmgbsa_dg and error. Written, so that no compound is scored twice.

    The scorer gets a row as a dict and returns a number. What it raises becomes the row's error, so
    a task is never run again for one compound.
    """
    todo = picks if done is None else picks.join(done.where("error is null").select(*key), list(key), "left_anti")
    todo, rows = cut_and_count(todo)
    cols = todo.columns

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            scores, errors = [], []
            for row in part.to_dict("records"):
                score, error = None, None
                try:
                    score = float(scorer(row))
                except TimeoutError:
                    error = "timeout"
                except ScoringError as e:
                    error = str(e)
                except Exception as e:  # whatever an external scorer raises is this row's error
                    error = f"exception: {e}"
                scores.append(score)
                errors.append(error)
            yield part.assign(mmgbsa_dg=pd.Series(scores, index=part.index, dtype="float64"), error=pd.Series(errors, index=part.index, dtype="object"))

    kinds = ", ".join(f"`{c}` {t}" for c, t in todo.dtypes)
    scored = todo.repartition(max(1, -(-rows // rows_per_task))).mapInPandas(run, f"{kinds}, mmgbsa_dg double, error string")
    return cut_lineage(scored.select(*cols, "mmgbsa_dg", "error"))


def split_results(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(successes, failures)."""
    return scored.where("mmgbsa_dg is not null"), scored.where("mmgbsa_dg is null")


def drop_failed_chunks(scored: DataFrame, chunk: str) -> DataFrame:
    """Only chunks without any error; the others are to be run again as a whole."""
    bad = scored.where("error is not null").select(chunk).distinct()
    return scored.join(bad, chunk, "left_anti")


def secondary_rank(df: DataFrame, first: str, second: str, n: int = 20) -> DataFrame:
    """The best ``n`` by ``first`` beside their rank by ``second``."""
    both = ranked(ranked(df, [first], name="rank"), [second], name="other_rank")
    return both.where(F.col("rank") <= n)


def best_per_cluster(df: DataFrame, cluster: Sequence[str], score: str, lone: str = "singleton") -> DataFrame:
    """The best row of each cluster; rows whose source is ``lone`` pass through."""
    inside = best_per_key(df.where(F.col("source") != lone), cluster, [F.col(score), F.col("compound_id")])
    return inside.unionByName(df.where(F.col("source") == lone))
