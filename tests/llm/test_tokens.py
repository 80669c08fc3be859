"""Operators 1, 7 and 8 against the libraries."""

from __future__ import annotations

import base64
import hashlib
import json
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hearth.llm import byte_bpe, token_files
from hearth.llm.common import Scratch
from hearth.llm.queries import END_ID, tokenizer_path, tokenizer_pattern
from hearth.llm.token_counts import _counter, segments, token_counts
from hearth.llm.units import UnitCache, units
from tests.llm.conftest import odd_rows

MULTI = "byte_bpe_multi_50k.tiktoken"
STRANGE = ["  a b ", "a  b", "a \n b", "​x  y\t z ", " ", "", "a b ", "don't  stop\n\nnow", "é é <|endoftext|> </s> <s>", "x y z",
           "\x1c a \x1c", "一二三 四五 😀😀 a", "12345 678  9", "▁a ▁ b", "ΑΣ ΑΣ.", "é ́x", "<|startoftext|> <|endoftext|><|endoftext|> q"]


def counted(tokenizer, texts, limit=1 << 15):
    count, space, safe = _counter(tokenizer)
    assert safe
    return [sum(count([(space if i else "") + s for i, s in enumerate(segments(t, limit))])) for t in texts]


def library(tokenizer):
    """texts -> ids, by the library itself."""
    if tokenizer.endswith(".model"):
        import sentencepiece
        return lambda texts: sentencepiece.SentencePieceProcessor(model_file=tokenizer).encode(texts)
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer)
    return lambda texts: [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("limit", [1, 4, 1 << 15])
def test_counts_of_strange_texts(name, limit):
    path = tokenizer_path(name)
    assert counted(path, STRANGE, limit) == [len(x) for x in library(path)(STRANGE)]


#: White space of several kinds, marks that libraries treat alone, letters of several scripts, characters that compose or change with lower case.
ODD_CHARS = list("ab1.,'s \t\n\r\x0b\x1c\x85\xa0\u2003\u200b\u3000▁éÉßİıſŉ漢ыكﹰ\u0301ΑΣ😀<|>_-")


def odd_strings(seed, n):
    rng = np.random.default_rng(seed)
    spaced = ["".join(rng.choice(ODD_CHARS, rng.integers(0, 30))) for _ in range(n // 2)]
    return spaced + ["".join(rng.choice([" ", "  ", "\t", " \n", "\r", "\x85", "a", "b,", "it's", "▁", "漢", "É"], rng.integers(0, 12))) for _ in range(n // 2)]


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_counts_of_random_texts_in_short_segments(name):
    texts, path = odd_strings(1, 20_000), tokenizer_path(name)
    count, space, _ = _counter(path)
    cut = [segments(t, 3) for t in texts]
    got = iter(count([(space if i else "") + s for c in cut for i, s in enumerate(c)]))
    assert [sum(next(got) for _ in c) for c in cut] == [len(x) for x in library(path)(texts)]


def test_ids_of_random_texts():
    """Operator 8's cache of units and of their matches."""
    path = tokenizer_path("word_bpe_49k.json")
    texts = odd_strings(2, 20_000) + ["L'État, c'EST moi!", "x<|endoftext|>y <|startoftext|>", "<|", "|>", "''s 'S n't"]
    made = token_files.Encoder(path)
    assert made.matches and [np.frombuffer(x, made.kind).tolist() for x in made.encode(texts)] == library(path)(texts)
    made.matches = None
    assert [np.frombuffer(x, made.kind).tolist() for x in made.encode(texts)] == library(path)(texts)
    latin = ["".join(map(chr, np.random.default_rng(i).choice([*range(32, 127), *range(192, 384)], 60))) for i in range(5_000)]
    assert [np.frombuffer(x, made.kind).tolist() for x in token_files.Encoder(path).encode(latin)] == library(path)(latin)


def test_pattern_of_other_files_is_left_to_the_library():
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        assert token_files.plain_matches(json.load(f)) is None
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    assert token_files.plain_matches(spec)
    for pattern in (r"\p{L}+", r"[\p{Lu}]+", r"[\w]+"):
        spec["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": pattern}
        assert token_files.plain_matches(spec) is None


def test_segments_keep_the_text():
    text = " ".join(f"w{i}" for i in range(5_000))
    for limit in (1, 10, 10_000, 10**6):
        cut = segments(text, limit)
        assert " ".join(cut) == text and all(len(c) < limit + 8 for c in cut[:-1])
    assert segments("x" * 100, 10) == ["x" * 100] and segments("", 10) == [""] and segments("a ▁ b", 1) == ["a ▁ b"]


def test_count_rows(odd, empty):
    import sentencepiece
    path = tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    want = [(k, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for k, t in odd_rows()]
    got = [tuple(r) for r in token_counts(odd, path).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert token_counts(empty, path).collect() == []


@pytest.fixture(scope="module")
def tiktoken_model():
    import tiktoken
    with open(tokenizer_path(MULTI), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=tokenizer_pattern(), mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab' \n\t'sré…😀1٣́ .!<|>endof")), max_size=40))
def test_bpe_equals_tiktoken(tiktoken_model, text):
    head, later = byte_bpe._caches(tokenizer_path(MULTI), tokenizer_pattern())
    u = units(text)
    ids = head.holding({u[0]})[u[0]] + b"".join(map(later.holding(set(u[1:])).__getitem__, u[1:]))
    want = tiktoken_model.encode_ordinary(text)
    assert np.frombuffer(ids, "<u4").tolist() == want
    data, _ = byte_bpe.token_bytes(np.array(want, "<u4"), tokenizer_path(MULTI))
    assert data.tobytes() == text.encode()
    start, end = byte_bpe.char_offsets(np.array(want, "<u4"), tokenizer_path(MULTI))
    tokens = tiktoken_model.decode_tokens_bytes(want)
    for token, a, b in zip(tokens, start, end):
        assert token in text[a:b].encode()
        assert len(text[a:b].encode()) == len(token) or len(text[a:b].encode()) - len(token) <= 6


def test_bpe_rows_round_trip(odd, empty, tiktoken_model):
    ranks, pattern = tokenizer_path(MULTI), tokenizer_pattern()
    got = byte_bpe.decode(byte_bpe.encode(odd, ranks, pattern), ranks).collect()
    want = [(k, tiktoken_model.encode_ordinary(t or ""), (t or "").encode()) for k, t in odd_rows()]
    assert sorted([(r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in got], key=str) == sorted(want, key=str)
    assert byte_bpe.digests(empty, ranks, pattern).collect() == []
    hashes = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.digests(odd, ranks, pattern).collect()]
    assert sorted(hashes, key=str) == sorted(((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                               hashlib.sha256(data).hexdigest()) for k, ids, data in want), key=str)
    spans = byte_bpe.encode(odd, ranks, pattern, offsets=True).where("doc_id = 8").first()
    assert (spans.starts, spans.ends) == ([0, 3], [3, 9])


def test_units_of_one_space_between_visible_characters():
    assert units("a b\nc d") == ["a", "b\nc", "d"]
    assert units(" a  b c ") == [" a  b", "c "]
    assert units("") == [""]


def test_unit_cache_forgets_but_stays_right():
    cache = UnitCache(lambda texts: [len(t) for t in texts], size=3)
    for part in (["a", "bb"], ["ccc", "dddd"], ["a", "e"], ["ff"], ["bb", "a"]):
        known = cache.holding(set(part))
        assert [known[p] for p in part] == [len(p) for p in part]
    assert len(cache.now) <= 6


def test_perfect_hash_is_minimal_and_tells_strangers():
    keys = np.arange(-500, 5000, 7, dtype=np.int64)
    mph = token_files.PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
    others = np.arange(10**6, 10**6 + 5000, dtype=np.int64)
    slot, order = mph.slots(others), np.argsort(mph.slots(keys))
    held = slot >= 0
    assert not (token_files.fingerprints(keys[order])[slot[held]] == token_files.fingerprints(others[held])).any()


def test_token_files_round_trip(spark, odd, empty):
    from tokenizers import Tokenizer
    path = tokenizer_path("word_bpe_49k.json")
    tok, n, want = Tokenizer.from_file(path), 0, []
    rows = [(k, tok.encode(t or "", add_special_tokens=False).ids + [END_ID]) for k, t in odd_rows() + [(20, s) for s in STRANGE]]
    for k, ids in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes())):
        want.append((k, n, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        n += len(ids)
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(20, s) for s in STRANGE], "doc_id long, text string"))
    got = [tuple(r) for r in token_files.digests(docs, path, END_ID).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert token_files.digests(empty, path, END_ID).collect() == []


def test_keyed_access(spark, odd):
    path, scratch = tokenizer_path("word_bpe_49k.json"), Scratch(spark)
    folder = scratch.path()
    shards = token_files.write_shards(odd, path, folder, END_ID, scratch)
    asked = spark.createDataFrame([(8,), (8,), (777,), (-5,), (11,)], "doc_id long")
    got = token_files.read_documents(asked, folder, shards).collect()
    assert sorted(r.doc_id for r in got) == [8, 11, 11, 11]
    from tokenizers import Tokenizer
    assert np.frombuffer(next(r for r in got if r.doc_id == 8).ids, "<u4").tolist() == \
        Tokenizer.from_file(path).encode("two words", add_special_tokens=False).ids + [END_ID]


def test_a_lost_attempt_leaves_no_listed_file(tmp_path):
    """An attempt that ends before its list line, after either file, doesn't touch what another one committed."""
    kind, folder = np.dtype("<u2"), f"file://{tmp_path}"
    rows = [pa.record_batch({"doc_id": pa.array([i, i + 1]), "ids": pa.array([np.array([i, 2], kind).tobytes(), np.array([2], kind).tobytes()], pa.binary())})
            for i in (0, 10)]

    def dies():
        yield rows[0]
        raise RuntimeError("lost executor")

    (done,) = [b.to_pylist()[0] for b in token_files.write_shard(iter(rows), folder, 4, kind)]
    with pytest.raises(RuntimeError):
        list(token_files.write_shard(dies(), folder, 4, kind))
    (again,) = [b.to_pylist()[0] for b in token_files.write_shard(iter(rows), folder, 4, kind)]
    assert done["name"] != again["name"] and done | again == again | {"name": again["name"]}
    for line in (done, again):
        shard = token_files.Shard(folder, line["name"])
        pos, rec = shard.records(np.array([10, 99, 1], np.int64))
        found = {int(p): ids.tolist() for some, data in shard.read(rec) for p, ids in zip(pos[some], data)}
        assert found == {0: [10, 2], 2: [2]}
