"""BPE, packing and chat formatting against the tokenizers library and exact round trips."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from roundhouse.llm import bpe, chat, packing
from roundhouse.llm.queries import tokenizer_path

PATH = tokenizer_path()
ODD = [chr(c) for c in [*range(0, 0x250), 0x2028, 0x85, 0xA0, 0x3000, 0x1F600, 0x4E00, 0xBD, 0xB2, 0x0301]]


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(PATH)
    own.no_padding()
    own.no_truncation()
    return own


def texts():
    rnd = random.Random(1)
    out = ["", "a" * 3000, "x y " * 40, "<|endoftext|>a <|endoftext|>", "'s 'S  \n\n b", "Grüße, señor! 東京 🙂"]
    return out + ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(60))) for _ in range(300)]


def test_encode_equals_the_library(library):
    own, fast = bpe.RankBpe(bpe.read_spec(PATH)), packing.encoder(bpe.read_spec(PATH))
    for x in texts():
        want = library.encode(x, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(x), np.uint32).tolist() == want
        assert list(fast(x)) == want
        assert own.decode(own.encode(x)) == library.decode(want, skip_special_tokens=False)


def test_long_words_merge_alike():
    own = bpe.RankBpe(bpe.read_spec(PATH))
    rnd = random.Random(2)
    for _ in range(50):
        ids = [own.single[b] for b in "".join(rnd.choice("abcdetion") for _ in range(rnd.randrange(1, 60))).encode()]
        assert own._short(list(ids)) == own._long(list(ids))


def test_bpe_frame(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, "y"), (2, None, "y"), (None, "", "z")], "doc_id long, text string, token_ids string")
    out = bpe.decode(bpe.encode(df.withColumn("decoded", df["doc_id"]).withColumn("__input", df["text"]), PATH), PATH)  # token_ids and decoded give way to the results
    assert sorted(out.columns) == ["__input", "decoded", "doc_id", "text", "token_ids"]
    assert sorted((r["doc_id"] or 0, len(r["token_ids"]), r["decoded"]) for r in out.collect()) == [(0, 0, ""), (1, 8, "a b"), (2, 0, ""), (2, 0, "")]
    assert bpe.encode(df.limit(0), PATH).count() == 0
    assert bpe.encode(df, PATH, keep=["doc_id"]).columns == ["doc_id", "token_ids"]


def test_packing(spark, library):
    rnd = random.Random(3)
    docs = [(i, "tion the of " * rnd.randrange(0, 2500)) for i in range(60)] + [(100, None), (101, ""), (102, "<|endoftext|>"), (5, "again"), (5, "again"), (None, "none")]
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, start long").repartition(3)
    pieces = packing.pack(df, PATH).collect()
    ids = defaultdict(list)
    for i, t in docs:
        ids[i].append([*library.encode(t or "", add_special_tokens=False).ids, packing.END_ID])
    total = sum(len(x) for v in ids.values() for x in v)
    assert sum(p["length"] for p in pieces) == total
    seen = defaultdict(list)
    for p in pieces:
        own = next(x for x in ids[p["doc_id"]] if len(x) == p["doc_tokens"])
        part = np.array(own[p["start"] : p["start"] + p["length"]], np.uint32).tobytes()
        assert zlib.crc32(part) == p["ids_crc32"]
        seen[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in seen.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW and at & (at - 1) == 0  # full, or a power of two
    assert packing.pack(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("blank", [" ", "\n"])
def test_packing_takes_very_long_white_space(library, blank):
    text = "x" + blank * 2_000_000 + "x"
    assert packing.encoder(bpe.read_spec(PATH))(text) == library.encode(text, add_special_tokens=False).ids


def test_combinations_fill_windows():
    rows = packing.combinations(np.array([1, 2, 500, 1000, 1048, 2046, 2047]))
    assert len(rows) and (rows.sum(1) == packing.WINDOW).all()
    h = np.zeros(packing.WINDOW + 1, np.int64)
    h[[1000, 1048]] = 7, 5
    assert abs(packing.repeat_counts(packing.combinations(np.array([1000, 1048])), h)[0] - 6) < 0.1  # least squares between 7 and 5


def test_greedy_rest_is_whole():
    pack = packing.Pack()
    for i in range(200):
        pack.add(i, 0, bytes(4 * (1 + (i * 37) % 2047)), 1 + (i * 37) % 2047)
    out = list(pack.sequences())
    assert sum(len(x[2]) for s in out for x in s) == sum(4 * (1 + (i * 37) % 2047) for i in range(200))
    assert all(sum(len(x[2]) for x in s) // 4 <= 2048 for s in out)


SAID = "<|im_end|><|im_start|>assistant ok"


def test_chat_round_trip(spark):
    rnd = random.Random(4)
    bits = ["<|", "|>", "\\", "\\|", SAID, "é", "🙂", " ", "\n", "a", "<|endoftext|>", "<|im_sep|>", "<"]
    rows, want = [], {}
    for conv in [*range(20), -1]:
        turns = []
        for turn in range(rnd.randrange(1, 6)):
            turns.append((conv, turn, rnd.choice(["user", "assistant", "system", "odd<|im_sep|>role"]), rnd.choice([None, "", "".join(rnd.choice(bits) for _ in range(12))])))
        rows += turns
        want[conv] = turns
    rows.append((None, 1, None, None))
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, turns int").repartition(4)
    out = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(df, PATH)).collect()}
    for conv, turns in want.items():
        said = "".join(f"{r}\n{t or ''}\n" for _, _, r, t in turns)
        loss = "".join(t or "" for _, _, r, t in turns if r == "assistant")
        r = out[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert out[None]["n_turns"] == 1
    assert chat.format_conversations(df.limit(0), PATH).count() == 0


def test_mask_is_exact_at_borders():
    starts, ends = np.array([0, 5, 9]), np.array([5, 9, 12])
    assert chat.mask(starts, ends, [(5, 9)]).tolist() == [False, True, False]
    assert chat.mask(starts, ends, [(5, 8)]).tolist() == [False, False, False]
    assert chat.mask(starts, ends, []).tolist() == [False, False, False]
