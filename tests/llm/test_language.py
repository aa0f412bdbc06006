import math
from collections import Counter

from helpers import awkward, crc, empty

from shelfwise.llm import language


def letters_grams(text):
    out = Counter()
    word = ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            padded = f"\1{word}\1"
            out.update(word)
            out.update(padded[i:i + 2] for i in range(len(padded) - 1))
            out.update(padded[i:i + 3] for i in range(len(padded) - 2))
            word = ""
    return out


def ranked(counter, size):
    return [g for g, _ in sorted(counter.items(), key=lambda x: (-x[1], code(x[0])))][:size]


def code(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


def brute(rows, size=language.PROFILE):
    by = {}
    for doc_id, text, lang in rows:
        if doc_id is not None and crc(doc_id) % 5 and text is not None and lang is not None:
            by.setdefault(lang, Counter()).update(letters_grams(text))
    profiles = {lang: {g: i for i, g in enumerate(ranked(c, size))} for lang, c in by.items() if c}
    out = []
    for doc_id, text, _ in rows:
        own = ranked(letters_grams(text or ""), size)
        held = doc_id is None or crc(doc_id) % 5 == 0
        if not own or not profiles:
            out.append((doc_id, held, "und", 0.0))
            continue
        far = {lang: sum(min(size, abs(p[g] - i)) if g in p else size for i, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        out.append((doc_id, held, best, 1 - far[best] / (size * len(own))))
    return out


def same(got, want):
    order = lambda r: (r[0] is None, r[0] or 0)
    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert all(math.isclose(a[3], b[3], abs_tol=1e-12) for a, b in zip(got, want))


def test_against_brute_force(docs):
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    got = language.identify(docs).collect()
    same(got, brute(rows))
    true = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out and true[r.doc_id]]
    assert sum(r.lang_pred == true[r.doc_id] for r in held) >= 0.9 * len(held)


def test_awkward_rows(llm):
    table = awkward(llm)
    same(language.identify(table).collect(), brute([(r.doc_id, r.text, r.lang) for r in table.collect()]))


def test_empty_and_unlearnable(llm):
    assert language.identify(empty(llm)).collect() == []
    nothing = language.identify(awkward(llm, [(1, "some text", None, "a")])).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]


def test_stage_keeps_rows_whole(llm):
    table = awkward(llm)
    kept = language.keep_identified(table)
    assert kept.columns == table.columns
    ids = sorted(r.doc_id or 0 for r in kept.collect())
    assert {1, 5, 6, 8, 9, 13} <= set(ids) and not {2, 3, 4, 7} & set(ids) and ids.count(5) == 2
    assert language.keep_identified(empty(llm)).collect() == []
    english = [(i, "the cat and the dog on the mat", "en", "a") for i in range(20)]
    foreign = next(i for i in range(100, 200) if crc(i) % 5 == 0)  # not learned from
    odd = awkward(llm, [*english, (foreign, "Ψυχή μου κόσμος", "el", "a")])
    assert {r.doc_id for r in language.keep_identified(odd).collect()} == set(range(20))
    unlabelled = awkward(llm, [(1, "some text", None, "a"), (2, "123", None, "a")])
    assert [r.doc_id for r in language.keep_identified(unlabelled).collect()] == [1]
