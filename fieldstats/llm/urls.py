"""URL filter: path rules, then a weighted vocabulary of terms found by Aho-Corasick.

One strict term at word boundaries rejects a URL, as do several distinct soft
terms. Terms are matched in host and path, A-Z lower-cased; soft terms may
stand anywhere between boundaries, strict ones too: a boundary is any character
but a letter or digit, or the end.
"""

from __future__ import annotations

from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rules (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Vocabulary of the default filter: weights of soft terms add up over distinct terms.
STRICT = ("casino", "porn", "xxx", "malware", "phishing", "warez", "escort", "viagra")
SOFT = {"ads": 1, "banner": 1, "bet": 1, "bonus": 1, "click": 1, "coupon": 1, "deal": 1, "free": 1, "poker": 2, "sex": 2, "spam": 2, "tracker": 1, "win": 1}


@dataclass(frozen=True)
class UrlPolicy:
    rules: tuple[tuple[str, str, str], ...] = RULES
    strict: tuple[str, ...] = STRICT
    soft: tuple[tuple[str, int], ...] = tuple(SOFT.items())
    soft_weight: int = 3
    soft_terms: int = 2


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Lower-cased host and path; both empty for null or without ``://``."""
    before, sign, rest = (url or "").partition("://")
    if not sign:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:end].translate(_LOWER), rest[end:]
    stop = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return host, rest[:stop]


class UrlJudge:
    """A policy, ready to be applied."""

    def __init__(self, policy: UrlPolicy):
        self.policy = policy
        self.rules: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, host, path in policy.rules:
            self.rules.setdefault(host, []).append((path, host + path, verdict))
        for own in self.rules.values():
            own.sort(key=lambda r: -len(r[0]))
        self.automaton = ahocorasick.Automaton()
        for term in policy.strict:
            self.automaton.add_word(term, (term, 0))
        for term, weight in policy.soft:
            self.automaton.add_word(term, (term, weight))
        self.automaton.make_automaton()

    def rule(self, host: str, path: str) -> tuple[str, str] | None:
        """Text and verdict of the longest rule that fits."""
        best = None
        at = 0
        while host and at >= 0:
            for prefix, text, verdict in self.rules.get(host[at:], ()):
                if path.startswith(prefix) and (best is None or len(text) > len(best[0])):
                    best = text, verdict
            at = host.find(".", at)
            at = at + 1 if at >= 0 else -1
        return best

    def terms(self, text: str) -> tuple[set[str], dict[str, int]]:
        """Distinct strict and soft terms at boundaries."""
        strict, soft = set(), {}
        for end, (term, weight) in self.automaton.iter(text):
            begin = end - len(term)
            if (begin < 0 or not text[begin].isalnum()) and (end + 1 == len(text) or not text[end + 1].isalnum()):
                if weight:
                    soft[term] = weight
                else:
                    strict.add(term)
        return strict, soft

    def judge(self, url: str | None):
        host, path = split_url(url)
        strict, soft = self.terms(f"{host}{path}".translate(_LOWER))
        rule = self.rule(host, path)
        weight = sum(soft.values())
        bad = bool(strict) or len(soft) >= self.policy.soft_terms and weight >= self.policy.soft_weight
        verdict = rule[1] if rule else "block" if bad else "allow"
        return host, path, rule[0] if rule else None, verdict, len(strict), len(soft), weight


_NAMES = ("host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight")
_KINDS = ("string", "string", "string", "string", "long", "long", "long")


def judged(pages: DataFrame, policy: UrlPolicy = UrlPolicy()) -> DataFrame:
    """(page_id, host, path, rule, verdict, n_strict, n_soft, soft_weight) per row of pages (page_id, url).

    A null url, or one without ``://``, has an empty host and path and is
    allowed. Null and repeated ids are passed on; other columns are ignored.
    """
    schema = pa.schema([("page_id", pa.int64()), *[(n, pa.string() if k == "string" else pa.int64()) for n, k in zip(_NAMES, _KINDS, strict=True)]])

    def run(batches):
        judge = UrlJudge(policy)
        for batch in batches:
            found = [judge.judge(u) for u in batch.column("url").to_pylist()]
            columns = list(zip(*found, strict=True)) or [()] * len(_NAMES)
            arrays = [batch.column("page_id").to_pylist(), *map(list, columns)]
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, arrays, strict=True)), schema=schema)

    kinds = ", ".join(f"{n} {k}" for n, k in zip(_NAMES, _KINDS, strict=True))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url").mapInArrow(run, f"page_id long, {kinds}")
