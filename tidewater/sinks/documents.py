"""Indexing documents in a search store.

The store's client is the caller's: ``connect()`` runs once per task and returns
``send(index, [(id, source), ...])``, which answers one word per document: ``ok``,
``rejected`` or ``timeout`` (worth another try), anything else is final. Ids are chosen
by the caller, so sending a document twice overwrites it with itself.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame

from tidewater.functions.json import json_put, members_put
from tidewater.operators.latest import latest

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Send = Callable[[str, list[tuple[str, str]]], list[str]]

OK = "ok"
WORTH_RETRY = ("rejected", "timeout")


def documents(df: DataFrame, identity: Column, source: Column, kind: Column | None = None,
              keep: tuple[str, ...] = (), members: Column | None = None) -> DataFrame:
    """``id, source`` rows and the columns ``keep``; ``kind`` overrides the member ``eventType`` of the source.

    ``members`` are the source's members if it has been parsed already.
    """
    body = source
    if kind is not None:
        body = json_put(source, "eventType", kind) if members is None else members_put(members, "eventType", kind)
    return df.select(identity.cast("string").alias("id"), body.alias("source"), *keep)


def last_per_id(df: DataFrame, order: str) -> DataFrame:
    """What the store would hold in the end: the last document per id."""
    return latest(df, ["id"], [order])


def index_documents(docs: DataFrame, index: str, connect: Callable[[], Send], bulk_size: int = 500,
                    tries: int = 5, pause_seconds: float = 1.0) -> DataFrame:
    """Send ``id, source`` rows and return those the store did not take, with the answer.

    Sending happens when the result is written: write it to a dead-letter table.
    """

    def deliver(send: Send, chunk: pd.DataFrame) -> pd.DataFrame:
        pending, refused = chunk, []
        for attempt in range(tries):
            if attempt:
                time.sleep(pause_seconds)
            try:
                answers = send(index, list(zip(pending["id"], pending["source"], strict=True)))
            except TimeoutError:
                answers = ["timeout"] * len(pending)
            answered = pending.assign(answer=list(answers))
            retry = answered["answer"].isin(WORTH_RETRY)
            refused.append(answered[~retry & (answered["answer"] != OK)])
            pending = answered[retry]
            if pending.empty:
                break
        return pd.concat([*refused, pending])

    def deliver_all(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        send = connect()
        for chunk in chunks:
            for start in range(0, len(chunk), bulk_size):
                yield deliver(send, chunk.iloc[start:start + bulk_size])

    return docs.select("id", "source").mapInPandas(deliver_all, "id string, source string, answer string")
