"""Repeated runs of sentences, cut out of all but the first document."""

from __future__ import annotations

import re

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.llm.common import table
from finfilings.llm.registry import query
from finfilings.llm.repeats import Unit, cut_repeats, n_cut

#: A run has so many sentences and words at least.
SENTENCES, WORDS = 3, 18
#: A sentence of more words is cut after words that their own hash chooses, so that a
#: passage which starts in the middle of it is cut at the same places everywhere.
LONG, ONE_IN = 10, 6

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_TOKEN = re.compile(r"\S+")


class _Cuts(dict):
    """Word → does a long sentence break after it?  Bounded like the numbers of words."""

    def __missing__(self, word: str) -> bool:
        if len(self) >= 400_000:
            self.clear()
        answer = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 7) % ONE_IN == 0
        if len(word) <= 64:
            self[word] = answer
        return answer


_CUTS = _Cuts()


def contents(text: str) -> list[Unit]:
    """The units of :func:`sentences` without their places."""
    out: list[Unit] = []
    for sentence in _SENTENCE.findall(text):
        body = sentence.lower().split()
        if not body:
            continue
        begun = 0
        if len(body) > LONG:
            for k in range(len(body) - 1):
                if _CUTS[body[k]]:
                    out.append((" ".join(body[begun:k + 1]).encode("utf-8", "surrogatepass"), k + 1 - begun, 0, 0))
                    begun = k + 1
        out.append((" ".join(body[begun:]).encode("utf-8", "surrogatepass"), len(body) - begun, 0, 0))
    return out


def sentences(text: str) -> list[Unit]:
    """Sentences end with ``.``, ``!``, ``?`` or a line; compared in lower case, blanks squeezed."""
    out: list[Unit] = []
    for m in _SENTENCE.finditer(text):
        body = m.group().lower().split()
        if not body:
            continue
        start, end = m.span()
        if len(body) <= LONG:
            out.append((" ".join(body).encode("utf-8", "surrogatepass"), len(body), start, end))
            continue
        spots = [start + t.end() for t in _TOKEN.finditer(m.group())]
        begun = 0
        for k, word in enumerate(body):
            if k + 1 == len(body) or _CUTS[word]:
                stop = end if k + 1 == len(body) else spots[k]
                out.append((" ".join(body[begun:k + 1]).encode("utf-8", "surrogatepass"), k + 1 - begun, start, stop))
                begun, start = k + 1, stop
    return out


def dedup_sentences(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``documents`` with the text without repeated runs of sentences, plus ``cuts, first_ids``.

    A run is the shortest one from a sentence on with ``SENTENCES`` sentences and ``WORDS``
    words.  Of equal runs the first in the order of doc_id (null first) and position stays;
    sentences that any other one covers go, with the blanks before them.

    Null and empty texts, and texts shorter than a run, stay as they are.  Rows equal in id
    and text count as one document.  A text may lose all its sentences.  Extra columns pass
    through; ``cuts`` and ``first_ids`` are replaced.
    """
    return cut_repeats(documents, sentences, SENTENCES, WORDS, text=text, doc_id=doc_id, unplaced=contents)


@query("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_sentences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", n_cut().alias("n_cut"), F.coalesce("first_ids", F.array().cast("array<bigint>")).alias("first_ids"))
