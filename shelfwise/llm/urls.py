"""URL filters: rules by host and path, else host word segmentation and naive Bayes.

Method: a unigram Viterbi splits concatenated host names and path parts into words of the pages'
own text; a multinomial naive Bayes over the segmented tokens, fitted on urls that a rule
decides, judges the urls that no rule fits.

Defined results: a null url or one without `://` has empty host and path; no rule fits it, and
having no tokens it gets the more frequent verdict of the fit (allow on a tie or without a fit).
Repeated rows are judged alike; null page_id stays null; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import counted, rows_to_batch
from shelfwise.session import materialise

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A word of the dictionary has at least this share of all words, so it has 1 / share entries at most.
LEAST_SHARE = 1e-6
# Naive Bayes is fitted on so many rule-decided urls at most, those with the smallest hashes.
FIT_URLS = 50_000
LONGEST_WORD = 24
TAGS = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>")
LETTERS = re.compile(r"[^\W\d_]+")
PARTS = re.compile(r"[^\W\d_]+|\d+")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty for null or without `://`."""
    at = F.locate("://", url)
    rest = F.substring(url, at + 3, F.length(url))
    known = url.isNotNull() & (at > 0)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Longest fitting rule (host and path joined) and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for judged, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(judged)).otherwise(verdict)
    return name, verdict


WORDS_SCHEMA = pa.schema([("word", pa.string()), ("n", pa.int64())])


def page_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts = (LETTERS.findall(TAGS.sub(" ", t).lower()) for b in batches for t in b.column(0).to_pylist() if t)
    for held in counted(texts):
        yield rows_to_batch(list(held.items()), WORDS_SCHEMA)


def dictionary(pages: DataFrame, least_share: float = LEAST_SHARE) -> tuple[dict[str, float], float]:
    """log10 probability per frequent word of the pages' texts, and log10 of all words' number."""
    words = materialise(
        pages.select("html").mapInArrow(page_words, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")), "url-words")
    total = words.agg(F.sum("n")).first()[0] or 1
    kept = words.where(F.col("n") >= least_share * total).collect()  # 1 / least_share rows at most
    return {r["word"]: math.log10(r["n"] / total) for r in kept}, math.log10(total)


def segment(name: str, words: dict[str, float], log_total: float, longest: int = LONGEST_WORD) -> list[str]:
    """Most probable split into words; an unknown piece of n letters costs 10 ** -n / total."""
    best, cut = [0.0], [0]
    for end in range(1, len(name) + 1):
        top, at = -math.inf, end - 1
        for start in range(max(0, end - longest), end):
            piece = name[start:end]
            score = best[start] + words.get(piece, -log_total - len(piece))
            if score > top:
                top, at = score, start
        best.append(top)
        cut.append(at)
    out, end = [], len(name)
    while end:
        out.append(name[cut[end]:end])
        end = cut[end]
    return out[::-1]


class Segmenter:
    """Splits hosts and paths; names already seen are kept, up to a bounded number."""

    def __init__(self, words: dict[str, float], log_total: float, most: int = 200_000):
        self.words, self.log_total, self.most, self.seen = words, log_total, most, {}

    def tokens(self, host: str, path: str) -> list[str]:
        return [f"h:{t}" for t in self.of(host)] + [f"p:{t}" for t in self.of(path)]

    def of(self, text: str) -> list[str]:
        out = []
        for part in PARTS.findall(text.lower()):
            if part[0].isdigit():
                out.append("0" * min(len(part), 9))
                continue
            if part not in self.seen:
                if len(self.seen) >= self.most:
                    self.seen.clear()
                self.seen[part] = segment(part, self.words, self.log_total)
            out += self.seen[part]
        return out


class NaiveBayes:
    """Multinomial, add-one smoothed over the tokens seen in the fit."""

    def __init__(self, rows: list[tuple[str, list[str]]]):
        self.docs = Counter(verdict for verdict, _ in rows)
        self.tokens = {v: Counter() for v in self.docs}
        for verdict, tokens in rows:
            self.tokens[verdict].update(tokens)
        self.known = set().union(*self.tokens.values()) if self.tokens else set()
        self.base = {v: math.log(n / len(rows)) for v, n in self.docs.items()}
        self.denominator = {v: math.log(sum(c.values()) + len(self.known) + 1) for v, c in self.tokens.items()}

    def judge(self, tokens: list[str]) -> tuple[str, float]:
        """Verdict, and log odds of block; allow on a tie."""
        score = dict(self.base)
        for t in tokens:
            if t in self.known:
                for v in score:
                    score[v] += math.log(self.tokens[v][t] + 1) - self.denominator[v]
        if len(score) < 2:
            only = next(iter(score), "allow")
            return only, math.inf if only == "block" else -math.inf
        odds = score["block"] - score["allow"]
        return ("block" if odds > 0 else "allow"), odds


OUT = pa.schema([
    ("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()),
    ("verdict", pa.string()), ("segments", pa.string()), ("log_odds", pa.float64())])


def judge(pages: DataFrame, rules=RULES, fit_urls: int = FIT_URLS) -> DataFrame:
    """pages(page_id, url, html) -> page_id, host, path, rule, verdict, segments, log_odds."""
    spark = pages.sparkSession
    host, path = split_url(F.col("url"))
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), "url")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "url")
    words, log_total = dictionary(pages)
    fit = (
        parsed.where("rule is not null").orderBy(F.xxhash64("url"), "url").limit(fit_urls)
        .select("host", "path", "verdict").collect())
    splitter = Segmenter(words, log_total)
    model = NaiveBayes([(r["verdict"], splitter.tokens(r["host"], r["path"])) for r in fit])
    shared = spark.sparkContext.broadcast((words, log_total, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, log_total, model = shared.value
        splitter = Segmenter(words, log_total)
        for batch in batches:
            rows = []
            for page_id, host, path, rule, verdict in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                tokens = splitter.tokens(host, path)
                said, odds = model.judge(tokens)
                rows.append((page_id, host, path, rule, verdict or said, " ".join(tokens), odds))
            yield rows_to_batch(rows, OUT)

    return parsed.drop("url").mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string, segments string, log_odds double")
