"""Repeated passages by windows: whoever keeps a window holds all of it."""

import random

import pytest

from ferry.llm import substring_dedup as sub


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(n)]


def found(spark, rows):
    """Per document the removed pieces of text, in order."""
    out = {}
    text = dict(rows)
    for r in sorted(sub.find_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=lambda r: (r["doc_id"], r["start"])):
        piece = text[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(piece.split()) == r["n_words"]
        out.setdefault(r["doc_id"], []).append((piece, r["kept_in"]))
    return out


def test_parts_of_a_passage_seen_elsewhere_before(spark):
    rng = random.Random(3)
    sentences = [" ".join(words(rng, 13)).capitalize() + "." for _ in range(4)]
    passage, half = " ".join(sentences), " ".join(sentences[:2])
    other = lambda: " ".join(words(rng, 20)).capitalize() + "."
    rows = [(1, f"{other()} {half} {other()}"), (2, f"{other()} {' '.join(sentences[2:])}"),
            (10, f"{other()} {passage} {other()}"), (20, f"{other()} {passage}\n{other()}")]
    assert found(spark, rows) == {20: [(passage, 10)]}
    # four sentences of 15 words, three of them alone in documents 1, 2 and 3
    sentences = [" ".join(words(rng, 15)).capitalize() + "." for _ in range(4)]
    passage = " ".join(sentences)
    rows = [(i + 1, f"{other()} {s} {other()}") for i, s in enumerate(sentences[:3])] + [(i, f"{other()} {passage}") for i in (10, 20)]
    assert found(spark, rows) == {20: [(passage, 10)]}


def test_stock_lines_in_a_row_stay(spark):
    rng = random.Random(4)
    stock = [" ".join(words(rng, 12)).capitalize() + "." for _ in range(5)]
    apart = "\n".join(line + " " + " ".join(words(rng, 9)) + "." for line in stock)
    assert found(spark, [(1, apart), (2, "\n".join(stock))]) == {}


def covered(rows, n=sub.MIN_WORDS):
    """Per document a flag for each word: whether it stands in n words that an earlier document, or this one before, holds."""
    seen, out = set(), {}
    for doc, text in rows:
        ws = sub._lower(text or "").split()
        out[doc] = [False] * len(ws)
        for i in range(len(ws) - n + 1):
            window = tuple(ws[i:i + n])
            if window in seen:
                out[doc][i:i + n] = [True] * n
            seen.add(window)
    return out


def must_go(rows, n=sub.MIN_WORDS):
    """Per document the words inside passages of at least n + 2 * UNIT_WORDS - 1 words of one earlier place, but for what its ends may keep.

    Words count as equal here if their line ends are as well.
    """
    at, out = {}, {}
    for doc, text in rows:
        ends, k = set(), 0
        for line in sub._lower(text or "").split("\n"):
            k += len(line.split())
            ends.add(k - 1)
        ws = [(w, i in ends) for i, w in enumerate(sub._lower(text or "").split())]
        passages, mine = {}, {}
        for i in range(len(ws) - n + 1):
            window = tuple(ws[i:i + n])
            for d, j in [*at.get(window, ()), *((doc, j) for j in mine.get(window, ()))]:
                passages.setdefault((d, i - j), []).append(i)
            mine.setdefault(window, []).append(i)
        for window, places in mine.items():
            at.setdefault(window, []).extend((doc, j) for j in places)
        out[doc] = set()
        for starts in passages.values():
            first = 0
            for k in range(1, len(starts) + 1):
                if k == len(starts) or starts[k] != starts[k - 1] + 1:
                    lo, hi = starts[first], starts[k - 1] + n
                    if hi - lo >= n + 2 * sub.UNIT_WORDS - 1:
                        out[doc].update(range(lo + sub.UNIT_WORDS - 1, hi - sub.UNIT_WORDS))
                    first = k
    return out


def faults(rows, spans):
    """What is wrong with spans ``(doc_id, start, length)`` of documents with ids of their own, in order of their ids: words cut or kept wrongly."""
    text, may, must = dict(rows), covered(rows), must_go(rows)
    gone = {doc: set() for doc, _ in rows}
    for doc, start, length in spans:
        before, piece = text[doc][:start].split(), text[doc][start:start + length]
        assert piece == piece.strip() and (not text[doc][:start] or text[doc][:start][-1].isspace())
        gone[doc].update(range(len(before), len(before) + len(piece.split())))
    wrong = sum(not may[doc][i] for doc in gone for i in gone[doc])
    return wrong, sum(len(must[doc] - gone[doc]) for doc in gone), sum(map(len, gone.values()))


@pytest.mark.parametrize("punctuation", [True, False])
def test_passages_at_any_word_against_brute_force(spark, punctuation):
    rng = random.Random(11)
    ends = lambda ws: [w + "." if punctuation and rng.random() < 0.09 else w for w in ws]
    rows, planted = [], {}
    for k in range(200):
        passage = ends(words(rng, 51 + k % 10))
        for copy in range(2):
            around, at = ends(words(rng, 60)), rng.randint(0, 60)
            rows.append((1000 * copy + k, " ".join(around[:at] + passage + around[at:])))
        planted[1000 + k] = len(passage)
    want = covered(rows)
    got = found(spark, rows)
    assert set(got) == set(planted)
    text = dict(rows)
    for doc, pieces in got.items():
        ((piece, keeper),) = pieces
        n = len(piece.split())
        assert keeper == doc - 1000 and 30 <= n <= planted[doc] == sum(want[doc]) and planted[doc] - n <= 2 * sub.UNIT_WORDS - 1
        before = len(text[doc][:text[doc].index(piece)].split())
        assert all(want[doc][before:before + n])


def test_windows_of_all_texts_at_once_equal_those_of_each(spark):
    texts = ["Ä b. C\nd! E", "", " 　x Y \n", "İ i̇ ΑΣ ας", " ".join(words(random.Random(1), 200))]
    c = sub.Cutter().cut(texts)
    single = [list(sub.units(t)) for t in texts]
    assert len(c.units) == sum(map(len, single))
    for t, us in zip(texts, single):
        assert " ".join(norm for *_, norm in us).split() == [sub._lower(w) for w in t.split()]
        assert all(t[a:b].split() and len(t[a:b].split()) == n <= sub.UNIT_WORDS for a, b, n, _ in us)


def test_rows_that_share_an_id_or_have_none(spark):
    rng = random.Random(13)
    rows, passages = [], []
    for doc in (None, 7):
        passages.append(" ".join(words(rng, 40)).capitalize() + ".")
        rows += [(doc, " ".join(words(rng, 20)) + f".\n{passages[-1]}\n" + " ".join(words(rng, 20))) for _ in range(3)]
    rows += [rows[0], (8, passages[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = sub.find_repeats(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"], r["kept_in"]) for r in spans) == [(0, 40, None)] * 2 + [(7, 40, 7)] * 2 + [(8, 40, 7)]
    texts = [r["text"] for r in sub.remove_repeats(docs).collect()]
    for passage in passages:  # the first row is there twice
        assert len({t for t in texts if passage in t}) == 1
