"""Tokens with their places in the unchanged text, and what is left of sentences once spans of it are held back.

A text is read from left to right here, so these are Arrow functions on batches of texts.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from unisono.functions.text import DATELINE, STRIP, TOKEN

_STRIP = [re.compile(p, re.ASCII) for p in STRIP]
_BREAK = re.compile(r"(?<=[.!?])\s+", re.ASCII)
_HEAD = re.compile(DATELINE, re.ASCII)
_TOKEN = re.compile(TOKEN)
SPANS = "array<struct<start:int,end:int>>"

Token = tuple[str, int, int]


def lower_in_place(text: str) -> str:
    """Lower case, character by character; one that would become two stays, so that places hold."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def sentence_tokens(text: str | None) -> list[list[Token]]:
    """(token, start, end) of each sentence that has tokens. What `clean_text` strips is blanked at its length."""
    plain = text or ""
    for p in _STRIP:
        plain = p.sub(lambda m: " " * len(m.group()), plain)
    low = lower_in_place(plain)
    ends = [m.span() for m in _BREAK.finditer(plain)]
    out = []
    for begin, end in zip([0, *(b for _, b in ends)], [*(a for a, _ in ends), len(plain)], strict=True):
        head = _HEAD.match(plain[begin:end])
        found = [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(low, begin + (head.end() if head else 0), end)]
        if found:
            out.append(found)
    return out


def held_before(length: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """[i]: how many places before i are held. A range [a, b) meets a span if and only if [b] > [a]."""
    marks = np.zeros(length + 1, np.int64)
    for start, end in spans:
        start, end = max(0, start), min(length, end)
        if end > start:
            marks[start] += 1
            marks[end] -= 1
    inside = np.cumsum(marks[:length]) > 0
    return np.concatenate([[0], np.cumsum(inside)])


def free_token_runs(text: str | None, spans: list[tuple[int, int]]) -> list[list[str]]:
    """The runs of tokens of each sentence that no span touches, within a token or between two: an n-gram lies in a run if and only
    if none of its places, first to last, is held."""
    out = []
    held = held_before(len(text or ""), spans) if spans else None
    for sentence in sentence_tokens(text):
        if held is None:
            out.append([t for t, _, _ in sentence])
            continue
        run: list[str] = []
        last = 0
        for token, start, end in sentence:
            if run and held[start] > held[last]:
                out.append(run)
                run = []
            if held[end] > held[start]:
                if run:
                    out.append(run)
                run = []
            else:
                run.append(token)
            last = end
        if run:
            out.append(run)
    return out


def token_spans(text: Column) -> Column:
    """array<array<struct<token,start,end>>> of a text's sentences."""

    @F.pandas_udf("array<array<struct<token:string,start:int,end:int>>>")
    def spans(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [[{"token": w, "start": a, "end": b} for w, a, b in sent] for sent in sentence_tokens(t)])

    return spans(text)


def free_runs(text: Column, held: Column) -> Column:
    """array<array<string>>, as `sentences` gives it, without what touches `held` (array<struct<start,end>>; null: nothing)."""

    @F.pandas_udf("array<array<string>>")
    def runs(ts: pd.Series, hs: pd.Series) -> pd.Series:
        return pd.Series([free_token_runs(t, [(h["start"], h["end"]) for h in (() if s is None else s)]) for t, s in zip(ts, hs, strict=True)])

    return runs(text, held.cast(SPANS))


# ---- sentences with abbreviations, and who speaks ----

# Patterns that results depend on.
LINES = re.compile(r"(?<=[.!?])\s+|\n+")
ABBREVIATION = re.compile(
    r"(?:\b[A-Za-z]|\b(?:v|vs|etc|no|art|sec|fig|st|mt|ft|dr|mr|mrs|ms|jr|sr|rep|reps|sen|sens"
    r"|gov|col|gen|lt|adm|capt|hon|prof|inc|corp|co|ltd|dept|univ"
    r"|jan|feb|mar|apr|jun|jul|aug|sept?|oct|nov|dec))\.$",
    re.IGNORECASE,
)
TITLE = r"(?:Rep\.|Sen\.|Reps\.|Sens\.|Representative|Senator|Congressman|Congresswoman|Dr\.|Mr\.|Ms\.|Mrs\.|Leader|Whip|Chairman|Chairwoman|Chair)"
NAME = r"[A-Z][A-Za-z.'’\-]+(?:\s+[A-Z][A-Za-z.'’\-]+){0,3}"
SAY = r"(?:said|says|stated|added|continued|concluded|noted|wrote)"
MARKER = re.compile(rf"\b{SAY}\s+(?:{TITLE}\s+)?({NAME})|\b(?:{TITLE}\s+)({NAME})\s+{SAY}\b")


def whole_sentences(text: str | None) -> list[tuple[int, int]]:
    """[start, end) of each sentence or line that isn't blank, trimmed. A full stop of an abbreviation ends none, so that what follows
    belongs to it as well."""
    t = text or ""
    cuts = [m.span() for m in LINES.finditer(t)]
    pieces = [(a, b) for a, b in zip([0, *(e for _, e in cuts)], [*(s for s, _ in cuts), len(t)], strict=True) if t[a:b].strip()]
    out: list[tuple[int, int]] = []
    open_end = False
    for a, b in pieces:
        out[-1:] = [(out[-1][0], b)] if open_end else [*out[-1:], (a, b)]
        open_end = bool(ABBREVIATION.search(t[max(out[-1][0], b - 40) : b].rstrip()))
    return [(b - len(t[a:b].lstrip()), a + len(t[a:b].rstrip())) for a, b in out]


def speaker_marks(text: str | None) -> list[tuple[int, int, list[str]]]:
    """[start, end) of what says who speaks ("said Rep. Doe", "Senator Doe added"), and the words of the name, lower-cased."""
    return [(m.start(), m.end(), sorted({w for w in (x.strip(".,'’-") for x in (m.group(1) or m.group(2) or "").lower().split()) if w})) for m in MARKER.finditer(text or "")]


def sentence_spans(text: Column) -> Column:
    @F.arrow_udf(SPANS)  # places go into plain arrays: a batch makes no object for each sentence
    def spans(s: pa.Array) -> pa.Array:
        start, end, upto = array("i"), array("i"), array("i", [0])
        for t in s:
            for a, b in whole_sentences(t.as_py()):
                start.append(a)
                end.append(b)
            upto.append(len(start))
        places = pa.StructArray.from_arrays([pa.array(np.asarray(x, np.int32)) for x in (start, end)], ["start", "end"])
        return pa.ListArray.from_arrays(pa.array(np.asarray(upto, np.int32)), places)

    return spans(text)


def spoken_sentences(text: Column) -> Column:
    """array<struct<start,end,names>>: each sentence with the names that its own markers give, else those of the nearest marker that
    begins before it; none where there is no such marker."""

    @F.pandas_udf("array<struct<start:int,end:int,names:array<array<string>>>>")
    def spans(s: pd.Series) -> pd.Series:
        def one(t):
            marks = speaker_marks(t)
            begins = [m[0] for m in marks]
            out = []
            for a, b in whole_sentences(t):
                # read in the sentence alone, where a name can't run on beyond its end
                own = speaker_marks(t[a:b])
                before = bisect_left(begins, a)
                names = [m[2] for m in own] or ([marks[before - 1][2]] if before else [])
                out.append({"start": a, "end": b, "names": names})
            return out

        return s.map(one)

    return spans(text)

