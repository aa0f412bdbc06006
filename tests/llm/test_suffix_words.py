"""Scoring cuts each text into words once and looks each different word up once."""

from shelfwise.llm import suffixtree


def test_texts_are_cut_once_and_words_looked_up_once():
    asked = []

    class Counting(suffixtree.Symbols):
        def of(self, word):
            asked.append(word)
            return super().of(word)

    ids = suffixtree.Known(Counting([b"a", b"b"], [b"ing"]))
    words = suffixtree.in_words([b"A b\tsing", None, b"b a sing x"])
    assert words == [[b"a", b"b", b"sing", b""], [b""], [b"b", b"a", b"sing", b"x", b""]]
    for _ in range(2):
        stream, place = suffixtree.in_symbols(words, ids)
    assert stream.tolist() == [0, 3, 4, 5, 1, 0, 1, 0, 4, 3, 5, 2, 1]
    assert place.tolist() == [0, 1, 2, 3, 4, 0, 1, 0, 1, 2, 3, 4, 5]
    assert sorted(asked) == sorted({b"a", b"b", b"sing", b"x", b""})


def test_words_below_the_share_are_told_by_their_missing_log():
    logs = suffixtree.Logs({b"a": -1.0})
    assert logs[b"a"] == -1.0 and logs[b"b"] != logs[b"b"] and list(logs) == [b"a"]
