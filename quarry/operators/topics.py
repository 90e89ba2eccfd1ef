"""Which topics occur in a text, for topic lists of any length.

A short list is a constant of the plan and every text is tried with each topic.  The cost of a
long list must not grow with it, so there

* whole tokens are an equi-join: the distinct tokens of each text, exploded and probed in a
  broadcast hash table of the topics inside one generated loop (no shuffle of posts);
* substrings are found by one multi-pattern automaton per task, which reads a text once.

What is broadcast is measured; a list beyond the limit is searched in parts.  All ways give the
same rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import WS_CLASS_BODY, tokenize
from quarry.session import BROADCAST_LIMIT_BYTES, ship_package, small_literal_frame, written

#: Up to this many topics each text is tried with every topic.
FEW_TOPICS = 32
#: Bytes of topics in one automaton (it takes some forty times as much memory).
AUTOMATON_BYTES = 4 << 20
#: Bytes of a row in a hash table beside its text.
_ROW_BYTES = 64


def topic_array(topics: list[str]) -> Column:
    """The topic list as one constant array of the plan."""
    return F.from_json(F.lit(json.dumps(topics)), "array<string>")


def _token_pattern(topic: str) -> str:
    """Java pattern of the topic with white space or an end of the text on both sides.  The topic comes
    first, so the search runs from one occurrence to the next."""
    quoted = "\\Q" + topic.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    return f"{quoted}(?<![^{WS_CLASS_BODY}]{quoted})(?![^{WS_CLASS_BODY}])"


def _is_token(topic: str) -> bool:
    return topic.split() == [topic]


def _few(posts: DataFrame, topics: list[str], whole_token: bool) -> DataFrame:
    text = F.col("text")
    if whole_token:
        pairs = [{"t": t, "p": _token_pattern(t)} for t in topics]
        known = F.from_json(F.lit(json.dumps(pairs)), "array<struct<t:string,p:string>>")
        tried = F.filter(known, lambda x: F.contains(text, x["t"]) & F.rlike(text, x["p"]))
        hits = F.transform(tried, lambda x: x["t"])
    else:
        hits = F.filter(topic_array(topics), lambda t: F.contains(text, t))
    return _labelled(posts, hits)


def _labelled(posts: DataFrame, hits: Column) -> DataFrame:
    """One row per hit.  The outer form keeps the optimizer from evaluating the hits once more to
    drop posts without any."""
    kept = [c for c in posts.columns if c != "university"]
    return posts.select(F.explode_outer(hits).alias("university"), *kept).where(F.col("university").isNotNull())


def _parts(topics: list[str], limit: int) -> list[list[str]]:
    out: list[list[str]] = [[]]
    size = 0
    for t in topics:
        size += len(t.encode()) + _ROW_BYTES
        if out[-1] and size > limit:
            out.append([])
            size = len(t.encode()) + _ROW_BYTES
        out[-1].append(t)
    return out


def _frames(spark: SparkSession, topics: list[str] | DataFrame) -> list[DataFrame]:
    """The topics as frames ``(university)`` that may each be broadcast."""
    if isinstance(topics, list):
        return [small_literal_frame(spark, [(t,) for t in part], "university string")
                for part in _parts(topics, BROADCAST_LIMIT_BYTES)]
    held = written(spark, topics.select(F.col(topics.columns[0]).alias("university")).distinct(), "topics")
    size = held.agg(F.sum(F.octet_length("university") + _ROW_BYTES).alias("n")).first()["n"] or 0
    n = -(-size // BROADCAST_LIMIT_BYTES) or 1
    if n == 1:
        return [held]
    return [held.where(F.pmod(F.xxhash64("university"), F.lit(2 * n)) == i) for i in range(2 * n)]


def _token_join(posts: DataFrame, topics: list[str] | DataFrame) -> DataFrame:
    kept = [c for c in posts.columns if c != "university"]
    tokens = posts.select(F.explode_outer(F.array_distinct(tokenize("text"))).alias("university"), *kept)
    out = None
    for frame in _frames(posts.sparkSession, topics):
        found = tokens.join(F.broadcast(frame), "university")
        out = found if out is None else out.unionByName(found)
    return out


def _automaton(topics: list[str]):
    everywhere = [""] if "" in topics else []
    words = [t for t in topics if t]

    @F.pandas_udf("array<string>")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        known = ahocorasick.Automaton()
        for t in words:
            known.add_word(t, t)
        known.make_automaton()
        for texts in batches:
            yield pd.Series([None if x is None else everywhere + list({t for _, t in known.iter(x)}) for x in texts])

    return hits


def match_topics(posts: DataFrame, topics: list[str] | DataFrame, whole_token: bool = False) -> DataFrame:
    """``posts`` labelled with each topic that their text contains (``university``): as a
    case-sensitive substring, or as a whole white-space separated token.  Topics may come as a
    frame (its first column) for whole tokens.  A NULL text matches nothing, a topic counts once, an
    empty topic is in every text and no token; a topic with white space in it is no token."""
    if isinstance(topics, DataFrame):
        if not whole_token:
            raise ValueError("a frame of topics is matched by whole tokens")
        return _token_join(posts, topics)
    asked = [t for t in dict.fromkeys(topics) if not whole_token or _is_token(t)]
    if len(asked) <= FEW_TOPICS:
        return _few(posts, asked, whole_token)
    if whole_token:
        return _token_join(posts, asked)
    ship_package(posts.sparkSession)
    out = None
    for part in _parts(asked, AUTOMATON_BYTES):
        found = _labelled(posts, _automaton(part)(F.col("text")))
        out = found if out is None else out.unionByName(found)
    return out
