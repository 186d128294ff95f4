"""URL rules by a bit-parallel wildcard automaton.

Each rule is a glob over the canonical url ``.host SEPARATOR path``; all rules are laid
side by side in the bits of as many 64-bit words as they need (Shift-And), and one step
per url byte moves all patterns of all urls of a batch at once.  ``*`` stands for any
run and ``?`` for any single byte, neither crossing from host to path.

A rule ``(host, path, verdict)`` fits its host and all subdomains when the url's path
starts with the rule's; both may hold wildcards.  Of several fitting rules the longest
(host and path together) wins, then the one with the longer host, then block before
allow.  Null urls, urls without ``://`` and urls that no rule fits get no rule and the
default verdict.  Host letters A-Z are lower-cased, nothing else is changed; a port or
user name counts as part of the host.  Long urls take more steps, not more memory per
step.  Repeated rows get equal results, other columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_schema, batch_of, strings

#: Parts host from path; no byte of UTF-8 text has this value.
SEPARATOR = 0xFF
#: Bytes of the url matrix of one pass.
PASS_BYTES = 4 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


class Automaton:
    """Masks of all rules: one bit per pattern place, the first bit of a rule is its start."""

    def __init__(self, rules: Sequence[Rule]):
        # Best rule first, so that the first accepting rule decides.
        self.rules = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != "block", r.name))
        bits: list[tuple[int, bool]] = []  # (byte, -1 for any, -2 for a start; stays on any byte)
        self.last = []
        for rule in self.rules:
            pattern = b"*." + rule.host.translate(str.maketrans(UPPER, LOWER)).encode() + bytes([SEPARATOR]) + rule.path.encode() + b"*"
            bits.append((-2, False))
            for byte in pattern:
                if byte == ord("*"):
                    bits[-1] = (bits[-1][0], True)
                else:
                    bits.append((-1 if byte == ord("?") else byte, False))
            self.last.append(len(bits) - 1)
        self.words = max(1, -(-len(bits) // 64))
        self.accepts = np.zeros((257, self.words), np.uint64)
        self.stays = np.zeros(self.words, np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for place, (byte, stays) in enumerate(bits):
            word, bit = place // 64, np.uint64(1) << np.uint64(place % 64)
            if byte == -2:
                self.start[word] |= bit
            elif byte == -1:
                self.accepts[:SEPARATOR, word] |= bit
            else:
                self.accepts[byte, word] |= bit
            if stays:
                self.stays[word] |= bit

    def first_match(self, urls: list[bytes]) -> np.ndarray:
        """Number of the winning rule per canonical url, -1 for none."""
        found = np.full(len(urls), -1, np.int64)
        order = sorted(range(len(urls)), key=lambda i: -len(urls[i]))
        at = 0
        while at < len(order):
            longest = max(len(urls[order[at]]), 1)
            part = order[at:at + max(1, PASS_BYTES // longest)]
            found[part] = self._run([urls[i] for i in part])
            at += len(part)
        return found

    def _run(self, urls: list[bytes]) -> np.ndarray:
        """All automata over urls sorted longest first."""
        sizes = np.array([len(u) for u in urls])
        longest = int(sizes[0])
        table = np.frombuffer(b"".join(u.ljust(longest, b"\0") for u in urls), np.uint8).reshape(len(urls), longest)
        state = np.tile(self.start, (len(urls), 1))
        active = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
        one, top = np.uint64(1), np.uint64(63)
        for step in range(longest):
            now = state[:active[step]]
            byte = table[:active[step], step]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[:active[step]] = (moved & self.accepts[byte]) | np.where((byte == SEPARATOR)[:, None], np.uint64(0), now & self.stays)
        found = np.full(len(urls), -1, np.int64)
        for number in reversed(range(len(self.rules))):
            place = self.last[number]
            found[(state[:, place // 64] >> np.uint64(place % 64)) & one == one] = number
        return found


def host_and_path(url):
    """Columns host and path of a url column; both empty for null and for urls without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return (F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))


def _judge(rules: Sequence[Rule], default: str):
    schema = arrow_schema("page_id long, host string, path string, rule string, verdict string")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(rules)
        for batch in batches:
            hosts, paths = strings(batch.column("host")), strings(batch.column("path"))
            urls = [b"." + h.encode() + bytes([SEPARATOR]) + p.encode() for h, p in zip(hosts.to_pylist(), paths.to_pylist())]
            winner = automaton.first_match(urls).tolist()
            yield batch_of(schema, [batch.column("page_id"), hosts, paths,
                                    [automaton.rules[w].name if w >= 0 else None for w in winner],
                                    [automaton.rules[w].verdict if w >= 0 else default for w in winner]])
    return judge


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", page_id: str = "page_id",
               url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), *host_and_path(F.col(url).cast("string")))
    return rows.mapInArrow(_judge(list(rules), default), "page_id long, host string, path string, rule string, verdict string")
