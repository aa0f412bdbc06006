"""Alignment against both libraries and plain loops."""

import hashlib
from bisect import bisect_left
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from helpers import ROWS, awkward, empty
from tokenizers import Tokenizer

from shelfwise.llm import alignment
from shelfwise.llm.encoding import byte_letters

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    (100, "a ▁ b", "en", "a"), (101, " \x00\t　é́ \U0001f600\U0001f469‍\U0001f469", "en", "a"), (102, "<s> </s> <0x0A> <|endoftext|> <unk>", "en", "a"),
    (103, "two  spaces   and\n\n lines ", "en", "a"), (104, "naïve ﬁ ①", "en", "a"), (105, "w" * 30_000, "en", "a"), (106, "The cat and the dog", "en", "a")]


def ends(parts):
    out, at = [], 0
    for p in parts:
        at += len(p)
        out.append(at)
    return out


def grouped(ids, at, cuts):
    out = {c: [] for c in cuts}
    for i, e in zip(ids, at):
        out[cuts[bisect_left(cuts, e)]].append(str(i))
    return out


def by_hand(rows):
    a_tok, b_tok = Tokenizer.from_file(FIRST), sentencepiece.SentencePieceProcessor(model_file=SECOND)
    a_tok.encode_special_tokens = True
    letter = {c: i for i, c in enumerate(byte_letters())}
    seen, linked = [], Counter()
    for doc_id, text in rows:
        given = (" " + (text or "")).encode()
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        as_bytes = [bytes(letter[c] for c in a_tok.id_to_token(i)) for i in a]
        pieces = [b_tok.id_to_piece(i) for i in b]
        bs_bytes = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if b"".join(as_bytes) != given or b"".join(bs_bytes) != given:
            a = b = as_bytes = bs_bytes = []
        end_a, end_b = ends(as_bytes), ends(bs_bytes)
        cuts = sorted(set(end_a) & set(end_b))
        group_a, group_b = grouped(a, end_a, cuts), grouped(b, end_b, cuts)
        groups = [",".join(group_a[c]) + "|" + ",".join(group_b[c]) for c in cuts]
        of_a, of_b = dict(zip(end_a, a)), dict(zip(end_b, b))
        links = [(of_a[c], of_b[c]) for c in cuts]
        linked.update(links)
        seen.append((doc_id, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if cuts else ""))
    most = Counter()
    for (_, y), n in linked.items():
        most[y] = max(most[y], n)
    return sorted(((i, n_a, n_b, n, len(links), sum(linked[p] == most[p[1]] for p in links), sum(linked[p] for p in links), sha)
                   for i, n_a, n_b, n, links, sha in seen), key=str)


def got(frame):
    assert frame.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, frame.collect()), key=str)


def test_given_documents(docs, llm):
    rows = docs.where("length(text) < 20000")
    assert got(alignment.compare(rows, FIRST, SECOND)) == by_hand([(r.doc_id, r.text) for r in rows.collect()])


@pytest.mark.parametrize("block", [alignment.BLOCK, 1, 60])
def test_awkward_rows(llm, block):
    table = awkward(llm, [r for r in ROWS if len(r[1] or "") < 100_000] + ODD)
    assert got(alignment.compare(table, FIRST, SECOND, block)) == by_hand([(r.doc_id, r.text) for r in table.collect()])


def test_no_tokens(llm):
    assert alignment.compare(empty(llm), FIRST, SECOND).collect() == []
    nothing = awkward(llm, [(1, None, "en", "a"), (2, "", "en", "a")])
    assert got(alignment.compare(nothing, FIRST, SECOND)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
