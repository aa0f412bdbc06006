"""The pipeline against plain versions of its stages, on whole small tables."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import test_language
import test_mixing_urls
import test_prints
import test_tokens
from helpers import awkward, crc, empty, words
from pyspark.sql import functions as F

from shelfwise.llm import language, mixing
from shelfwise.session import materialise

SF_DIR = "/root/testdata/sf0.001"


def test_stages_are_the_four():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "source_mixing", "best_fit_packing"]


def limits_by_hand(rows, said):
    """The least scores of the language stage, learned from the held-out labelled texts."""
    parts = [(lang, part) for i, text, lang in rows if lang is not None and text is not None and crc(i) % 5 == 0
             for part in language.starts_of(text)]
    by = {}
    for (lang, _), (found, score, grams) in zip(parts, said([part for _, part in parts])):
        if found == lang:
            for key in ((lang, grams.bit_length()), (None, grams.bit_length())):
                by.setdefault(key, []).append(math.floor(score * 100) / 100)
    limits = {}
    for key, scores in by.items():
        if len(scores) >= language.LEAST_SCORES:
            limits[key] = sorted(scores)[math.floor(language.ODD * len(scores))] - language.MARGIN
    return limits


def identified_by_hand(rows):
    learned = [(i, t, lang) for i, t, lang in rows]

    def said(texts):
        outside = next(i for i in range(10 ** 7, 10 ** 7 + 100) if crc(i) % 5 == 0)
        found = test_language.brute(learned + [(outside, t, None) for t in texts])[len(learned):]
        return [(r[2], r[3], min(len(test_language.letters_grams(t)), language.PROFILE)) for r, t in zip(found, texts)]

    limits, kept = limits_by_hand(rows, said), []
    for (i, *_), (lang, score, grams) in zip(rows, said([t or "" for _, t, _ in rows])):
        size = grams.bit_length()
        least = limits.get((lang, size), limits.get((None, size), language.LEAST_SCORE))
        if lang != "und" and score >= max(language.LEAST_SCORE, least) - 1e-12:
            kept.append(i)
    return kept


def mixed_by_hand(rows):
    """How many documents of each source and size are taken how often: places are known up to ties of size."""
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(len(words(r.text)))
    target = test_mixing_urls.level({s: sum(sizes) for s, sizes in by.items()})
    taken = Counter()
    for source, sizes in by.items():
        rate = target[source] / sum(sizes) if sum(sizes) else 0.0
        digest = hashlib.md5((mixing.SEED + ("-" if source is None else "=" + source)).encode()).hexdigest()
        u = int(digest[:8], 16) / 2 ** 32
        for place, size in enumerate(sorted(sizes), 1):
            taken[source, size] += math.floor(place * rate + u) - math.floor((place - 1) * rate + u)
    return +taken


def test_each_stage_against_plain_rules(docs, llm):
    """Each stage is judged on what the one before kept; ids and numbers of copies have to be equal."""
    stage = dict(corpus_pipeline.STAGES)
    first = materialise(stage["language_id"](llm, docs, SF_DIR), "stage")
    rows = docs.collect()
    assert sorted(r.doc_id for r in first.collect()) == sorted(identified_by_hand([(r.doc_id, r.text, r.lang) for r in rows]))
    second = materialise(stage["simhash_near_dedup"](llm, first, SF_DIR), "stage")
    rows = first.collect()
    least = {}
    for r, g in zip(rows, test_prints.brute_groups([test_prints.brute_print(r.text) for r in rows])):
        least[g] = min(least.get(g, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in second.collect()) == sorted(least.values())
    third = materialise(stage["source_mixing"](llm, second, SF_DIR), "stage")
    got = Counter((r.source, len(words(r.text))) for r in third.collect())
    assert got == mixed_by_hand(second.collect())
    check_packed(third.collect(), stage["best_fit_packing"](llm, third, SF_DIR).collect())


def test_pipeline_runs_its_stages(docs, llm):
    got = corpus_pipeline.run(llm, SF_DIR).collect()
    known = {r.doc_id: r for r in docs.collect()}
    check_packed([known[r.doc_id] for r in got if r.piece == 0], got)


def check_packed(texts, got):
    # every copy is packed whole, in order, without gaps
    want = []
    for r, ids in zip(texts, test_tokens.plain(test_tokens.WORD, [r.text for r in texts])):
        ids += b"\0\0\0\0"
        for n, at in enumerate(range(0, len(ids), 8192)):
            part = ids[at:at + 8192]
            want.append((r.doc_id, n, at // 4, len(part) // 4, zlib.crc32(part)))
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= 2048


def test_stages_stand_awkward_rows(llm):
    for table in (awkward(llm), empty(llm), awkward(llm).where(F.col("source").isNull())):
        table = materialise(table, "awkward")
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(llm, table, SF_DIR)
            if name != "best_fit_packing":
                assert kept.columns == table.columns
            kept.collect()
