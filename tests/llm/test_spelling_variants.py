"""Spelling variants against all pairs of small vocabularies."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

from tests.llm.corpus import SCHEMA, awkward, frame
from tidewell.llm import spelling_variants as s


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    met = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, others in met.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 10 * words[w]:
            form[w] = best
    out = []
    for w, k in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, k, len(met[w]), form.get(w), words.get(form.get(w)), root))
    return sorted(out)


def got(df):
    return sorted((r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in s.variants(df).collect())


def rows_of(texts):
    return [(i, t, None, None, 0, 0, 0, "", "", "") for i, t in texts]


def drawn(seed):
    """Words of two letters and of many, edits of edits, and counts over several powers of ten."""
    draw = random.Random(seed)
    letters = ("ab", "abcdefgh", "aàéÿ÷×z")[seed % 3]
    bag = []
    for _ in range(12):
        word = "".join(draw.choice(letters) for _ in range(draw.randrange(6, 12)))
        count = draw.choice([1, 2, 3, 25, 300, 4000])
        for _ in range(6):
            bag += [word] * count
            at = draw.randrange(len(word))
            word = draw.choice([word[:at] + word[at + 1 :], word[:at] + draw.choice(letters) + word[at:], word[:at] + draw.choice(letters) + word[at + 1 :]])
            count = max(1, count // draw.choice([1, 10, 12]))
    draw.shuffle(bag)
    return [(i if i % 7 else None, " ".join(bag[i::40])) for i in range(40)]


def test_all_pairs_of_drawn_words(spark):
    for seed in range(4):
        rows = drawn(seed)
        want = brute(rows)
        assert sum(r[2] > 0 for r in want) > 10 and any(r[3] != r[5] for r in want if r[3]) or seed
        assert got(frame(spark, rows_of(rows))) == want


def test_awkward_rows(spark):
    long = [(900 + i, "Straße NAÏVETÉ naïveté Naïvete naivete x×y÷zabc aaaaaaa aaaaaaaa aaaaaaaaa" + " longest" * 50_000) for i in range(3)]
    rows = awkward() + [(*r, None, None, 0, 0, 0, "", "", "") for r in long]
    assert got(frame(spark, rows)) == brute([r[:2] for r in rows])


def test_a_word_over_a_batch_of_counts(spark, monkeypatch):
    monkeypatch.setattr(s, "MOST_HELD", 3)
    rows = [(i, f"several different variants {'abcdefgh' * (i % 3)}") for i in range(20)]
    assert got(frame(spark, rows_of(rows))) == brute(rows)


def test_pivots_have_the_least_count():
    draw = random.Random(1)
    for _ in range(500):
        places = sorted(draw.sample(range(9), draw.randrange(3, 7)))
        grams = [(p, draw.randrange(5)) for p in places]
        total = {p: c for p, c in grams}
        best = min(total[a] + total[b] for a, b in itertools.combinations(places, 2) if b - a >= 2)
        a, b = s.pivots(grams)
        assert b - a >= 2 and total[a] + total[b] == best


def test_every_near_pair_shares_a_pivot():
    """The lemma, with repeated bigrams and ties: no near pair escapes the join."""
    for seed in range(60):
        draw = random.Random(seed)
        letters = "ab" if seed % 2 else "abcdé"
        words = sorted({"".join(draw.choice(letters) for _ in range(draw.randrange(7, 10))) for _ in range(60)})
        counts = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
        sign = {w: s.chosen(w, counts) for w in words}

        def meets(a, b):
            grams, places, pivots = sign[a]
            other = set(zip(sign[b][0], sign[b][1], strict=True))
            return any((grams[places.index(p)], p + move) in other for p in pivots for longer, move in s.MOVES if len(b) - len(a) == longer)

        assert all(meets(a, b) or meets(b, a) for a, b in itertools.combinations(words, 2) if near(a, b)), seed


def test_empty_table(spark):
    assert s.variants(spark.createDataFrame([], SCHEMA)).count() == 0
