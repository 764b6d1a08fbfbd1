"""What the models learn from, against plain counts."""

import math
import random
import statistics as st
import unicodedata
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from roundhouse.llm import quality_model, toxicity
from roundhouse.llm.textgrid import WordGrid


def is_word_char(c):
    return c.isalnum() or c == "_" or unicodedata.category(c)[0] == "M" or ord(c) >= 0x20000


def words_of(text):
    out, now = [], ""
    for c in text + "\n":
        if is_word_char(c):
            now += c
        elif now:
            out.append(now)
            now = ""
    return out


def lowered(word):
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in word)


def same_words(line):
    """Equal for lines with the same word characters at the same places."""
    return tuple(lowered(c) if is_word_char(c) else "" for c in line)


def slow_statistics(text):
    words = words_of(text)
    if not words:
        return [0.0] * 20
    kinds = Counter()
    for c in text:
        if c == "\n":
            kinds["line"] += 1
        elif c in "!|":
            kinds[c] += 1
        elif c in "#*$%&<>@^~=+_{}[]\\/":
            kinds["symbol"] += 1
        elif c in ".?…":
            kinds["stop"] += 1
        elif c.isspace():
            kinds["space"] += 1
        elif c.isdigit():
            kinds["digit"] += 1
        elif c.isupper():
            kinds["upper"] += 1
        elif c.isalpha():
            kinds["letter"] += 1
        elif ord(c) > 32:
            kinds["rest"] += 1
        else:
            kinds["control"] += 1
    n, sizes = len(words), [len(w) for w in words]
    chars = max(1, sum(v for k, v in kinds.items() if k not in ("line", "space")))
    low = [lowered(w) for w in words]
    runs = [tuple(low[i : i + 3]) for i in range(len(low) - 2)] or [tuple(low)]
    lines = [x for x in text.split("\n") if x]
    share = [kinds[k] / chars for k in ("control", "upper", "digit", "symbol", "stop", "rest")]
    again = lambda items: 1 - len(set(items)) / max(len(items), 1)
    closed = sum(x[-1] in "!.?…" for x in lines)
    return [
        math.log1p(n), st.mean(sizes), st.pstdev(sizes), math.log1p(max(sizes)), *share, kinds["!"] / n, kinds["|"] / n, kinds["symbol"] / n, again(low), again(runs), again([same_words(x) for x in lines]),
        closed / max(len(lines), 1), math.log1p(n / max(len(lines), 1)), sum(w[0].isupper() for w in words) / n, math.log1p(len(lines)),
    ]


def test_statistics_equal_plain_counts():
    rnd = random.Random(1)
    parts = ["word", "Word", "ÉTÉ", "été", "a1", "99", "!", "|", "#", ".", "…", "\n", "\n\n", " ", "  ", "\t", "-", "🙂", "é", "x_y", "\x01", ",", "/", "the the the", "same line\n"]
    texts = ["".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randrange(60))) for _ in range(150)] + ["", "\n", " ", "one", "a\n" * 500, "x" * 20_000]
    got = quality_model.statistics_batches(texts)
    assert got.shape == (len(texts), 20)
    for text, row in zip(texts, got, strict=True):
        assert np.allclose(row, slow_statistics(text), atol=2e-4), (text, row, slow_statistics(text))


def plain_pieces(text):
    """('w', word) and (k, stem) of each word that is longer than k."""
    out = set()
    for w in map(lowered, words_of(text)):
        out.add(("w", w))
        out |= {(k, w[:k]) for k in toxicity.STEMS if len(w) > k}
    return out


def hash_of(piece):
    kind, text = piece
    if kind == "w":
        return int(toxicity.pieces(WordGrid([text]))[0][0])
    return int(toxicity.pieces(WordGrid([text + "zzz"]))[1 + toxicity.STEMS.index(kind)][0])


def test_votes_and_lexicon_equal_plain_counts(spark):
    rnd = random.Random(2)
    plain = ["river", "stone", "walking", "walked", "green", "Ägypten", "über", "l'eau", "a", "of"]
    bad = ["grumbler", "grumbling", "grumbled", "snotter", "Zwergnase"]
    docs = []
    for i in range(400):
        toxic = i % 3 == 0
        words = [rnd.choice(plain) + rnd.choice(["", "", "s", "x" + str(rnd.randrange(50))]) for _ in range(rnd.randrange(5, 25))]
        if toxic:
            words[1:1] = rnd.sample(bad, 2)
        elif rnd.random() < 0.02:
            words.append("snotter")
        docs.append((i, " ".join(words) + rnd.choice([".", "!"]), int(toxic)))
    docs += [(1000 + i, docs[0][1], 1) for i in range(30)]  # copies share one vote
    df = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(d[0], d[2]) for d in docs], "doc_id long, label int")
    rows = toxicity.votes_of(toxicity.sample_of(df, labels)[0]).cache()
    votes = [(r["text"], r["label"], r["vote"]) for r in rows.collect()]
    copies = Counter(t for t, _, _ in votes)
    assert all(math.isclose(v, 1 / copies[t]) for t, _, v in votes if copies[t] > 20)
    assert all(v <= 1 / copies[t] + 1e-12 for t, _, v in votes)
    held = {0: defaultdict(float), 1: defaultdict(float)}
    total = Counter()
    for text, label, vote in votes:
        total[label] += vote
        for piece in plain_pieces(text):
            held[label][piece] += vote
    for label in (0, 1):
        got = {r["piece"] & (2**64 - 1): r["votes"] for r in toxicity.piece_votes(rows.where(F.col("label") == label)).collect()}
        want = {hash_of(p): v for p, v in held[label].items()}
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)
    tested = {p: v for p, v in held[1].items() if v >= 3}
    chance, chosen = total[1] / (total[0] + total[1]), set()
    for p, b in tested.items():
        c = held[0].get(p, 0.0)
        gain = b * math.log(b / (b + c) / chance) + (c * math.log(c / (b + c) / (1 - chance)) if c else 0)
        odds = math.log((b + 0.5) / (total[1] + 1)) - math.log((c + 0.5) / (total[0] + 1))
        if gain > math.log(len(tested)) + 5 and odds > 2.5:
            chosen.add(p)
    model = toxicity.fit(df, labels)
    assert set(model.lexicon.tolist()) == {hash_of(p) for p in chosen}
    assert {("w", "grumbler"), (6, "grumbl"), ("w", "zwergnase")} <= chosen and not {p for p in chosen if p[1] in ("river", "walki")}
    few = toxicity.fit(df, labels, entries=3)
    assert len(few.lexicon) == 3 and set(few.lexicon.tolist()) <= set(model.lexicon.tolist())
