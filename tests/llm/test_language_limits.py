"""The language stage on noise and on a language that was not learned."""

import os
import random

import pytest
from helpers import crc

from shelfwise.llm import language

DIR = "/root/testdata/sf0.01"
POLISH = (
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i "
    "powinni postępować wobec innych w duchu braterstwa.")


def test_noise_goes_and_clean_texts_stay(llm):
    if not os.path.isdir(DIR):
        pytest.skip("no test tables")
    docs = llm.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(1)
    noise = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n)) for n in (8, 16, 40, 200, 1000)]
    outside = [i for i in range(10 ** 6, 10 ** 6 + 100) if crc(i) % 5 == 0]
    short = [" ".join(r.text.split()[:n]) for r in docs.where("lang is not null and length(text) > 200").orderBy("doc_id").limit(20).collect() for n in (3, 6, 12)]
    added = [(i, t, None) for i, t in zip(outside, noise + [POLISH, POLISH * 5])] + [(2 * 10 ** 6 + i, t, None) for i, t in enumerate(short)]
    kept = {r.doc_id for r in language.keep_identified(docs.union(llm.createDataFrame(added, docs.schema))).select("doc_id").collect()}
    assert not kept & set(outside)
    assert {2 * 10 ** 6 + i for i in range(len(short))} <= kept
    labelled = {r.doc_id for r in docs.where("lang is not null and text rlike '[a-z]'").collect()}
    assert labelled <= kept
