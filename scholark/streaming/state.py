"""Stateful stream operators: the exact sliding-window limiter and running claims."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def rate_limiter(requests: DataFrame, client: str = "user_id", ts: str = "ts", seconds: int = 60, most: int = 10) -> DataFrame:
    """(client, event_id, ts, accepted): a request passes while fewer than ``most`` accepted ones lie within ``seconds``.

    The state of a client is the times of its accepted requests inside the window: at most ``most`` numbers.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(batches)).sort_values([ts, "event_id"], kind="stable")
        verdicts = []
        for t in rows[ts].astype("datetime64[us]").astype("int64"):
            kept = [x for x in kept if x > t - seconds * 1_000_000]
            ok = len(kept) < most
            if ok:
                kept.append(int(t))
            verdicts.append(ok)
        state.update((kept,))
        yield pd.DataFrame({client: rows[client], "event_id": rows["event_id"], ts: rows[ts], "accepted": verdicts})

    return requests.select(client, "event_id", ts).groupBy(client).applyInPandasWithState(step, f"{client} long, event_id long, {ts} timestamp, accepted boolean", "kept array<long>", "append", GroupStateTimeout.NoTimeout)


def running_claims(items: DataFrame) -> DataFrame:
    """Per claim and batch: papers seen, confidence blended (.9 old, .1 new) over new papers only, and the last update.

    A paper that a claim knows changes nothing, so a batch can be repeated safely.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        papers, confidence, n = (set(state.get[0]), state.get[1], state.get[2]) if state.exists else (set(), 0.0, 0)
        rows = pd.concat(list(batches)).dropna(subset=["paper_id", "confidence"]).sort_values("evidence_id")
        for p, c in zip(rows["paper_id"], rows["confidence"], strict=True):
            if p in papers:
                continue
            papers.add(p)
            confidence = c if n == 0 else 0.9 * confidence + 0.1 * c
            n += 1
        state.update((sorted(papers), float(confidence), n))
        yield pd.DataFrame({"claim_id": [key[0]], "paper_count": [n], "confidence": [float(confidence)]})

    rows = items.select("claim_id", "evidence_id", "paper_id", "confidence").where("claim_id is not null")
    return rows.groupBy("claim_id").applyInPandasWithState(step, "claim_id string, paper_count long, confidence double", "papers array<string>, confidence double, n long", "update", GroupStateTimeout.NoTimeout)
