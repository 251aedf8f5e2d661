"""Operators on texts against brute force: tokens, languages, repeats, secrets, similar sets."""

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter
from math import log2

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakemart.llm import bpe_recursive, byte_cnn, entropy_secrets, group_jaccard, lpf_dedup, queries, token_frames
from lakemart.llm.files import open_file
from lakemart.session import new_table_path

DOCS = "doc_id long, text string, lang string, ids string, start string, spans string, `key` int"


def documents(spark, texts, langs=None):
    """Rows with null ids and texts, repeats, and columns whose names operators use themselves."""
    rows = [(n, text, langs[n] if langs else "en", "x", "y", "z", n) for n, text in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def edge(spark):
    long = "word " * 40_000 + "end."
    texts = ["", None, "a", "  two  spaces \n\n and\tmore ", "It's 's don't été 日本語 😀", long, "same text", "same text"]
    df = documents(spark, texts)
    return df.unionByName(df.where("doc_id = 6")).unionByName(df.where("doc_id = 3").withColumn("doc_id", F.lit(None)))


def texts_of(df):
    return [(row["doc_id"], row["text"] or "") for row in df.select("doc_id", "text").collect()]


def bag(df, *columns):
    return Counter(tuple(row) for row in df.select(*columns).collect())


def small_documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


# ---- token ids in frames


def expected_frames(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return Counter(out)


def test_frames_on_edge_rows(spark, edge):
    path = new_table_path(spark, "frames")
    token_frames.write_shards(edge, path, frame_bytes=4096)
    ids = F.col("ids")
    found = token_frames.read_shards(spark, path).select("doc_id", "start", (F.octet_length(ids) / 4).cast("long"), F.crc32(ids))
    assert Counter(map(tuple, found.collect())) == expected_frames(texts_of(edge))


def test_frames_query(spark, small):
    found = queries.op1_token_frames(spark, small)
    assert Counter(map(tuple, found.collect())) == expected_frames(texts_of(small_documents(spark, small)))


def test_word_units_are_the_tokenizers_own():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, whole = token_frames.WordEncoder(path), Tokenizer.from_file(path)
    assert np.frombuffer(encoder.encode(["see <|endoftext|> here"])[0], "<u4").tolist() == [862, 49407, 763]
    pick = random.Random(7)
    parts = [
        "the", "The", "ING", "é", "É", "e\u0301", "\u0301", "ß", "ÿ", "×", "÷", "İ", "ŉ", "ſ", "ž", "Ā", "12", "3.5", "don't", "'s", "'", "-",
        "<|", "|>", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "<", "|", "...", "日本", "ª", "²", "½", "\x7f", "\x00",
        " ", " ", " ", "  ", "\n", "\t", "\r", "\xa0", "\u2028", "\x85", "😀", "ǅ", "ﬁ", "K",
    ]
    texts = ["".join(pick.choices(parts, k=pick.randrange(25))) for _ in range(4000)]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)]
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, a, b in zip(texts, got, want, strict=True) if a != b] == []


def test_long_texts_and_a_small_cache(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(token_frames, "STEP_BYTES", 400)
    monkeypatch.setattr(token_frames, "CACHE_UNITS", 50)
    pick = random.Random(1)
    texts = ["", "x" * 2000, " ".join(f"w{pick.randrange(900)}\n-é" for _ in range(900)), " " * 1500 + "end", "short one"]
    encoder, whole = token_frames.WordEncoder(path), Tokenizer.from_file(path)
    for _ in range(2):
        got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)]
        assert got == [whole.encode(text, add_special_tokens=False).ids for text in texts]


def test_frames_are_read_in_part(spark, small):
    path = new_table_path(spark, "frames")
    token_frames.write_shards(small_documents(spark, small).coalesce(1), path, frame_bytes=2048)
    whole = {r["doc_id"]: (r["start"], r["ids"]) for r in token_frames.read_shards(spark, path).collect()}
    some = token_frames.read_shards(spark, path, only=[3, 77]).collect()
    assert {r["doc_id"]: (r["start"], r["ids"]) for r in some} == {n: whole[n] for n in (3, 77)}
    name = spark.read.parquet(f"{path}/shards").first()["file"]
    with open_file(name) as file:
        reader = token_frames.FrameReader(file)
        place = reader.ids.to_pylist().index(77) if 77 in reader.ids.to_pylist() else 0
        list(reader.documents([place]))
        assert 0 < reader.frames_read < len(reader.checks)


def test_damaged_frame_is_an_error(tmp_path):
    import pyarrow as pa

    name = tmp_path / "shard.zst"
    with open(name, "wb") as out:
        writer = token_frames.FrameWriter(out, pa.int64(), 64)
        for n in range(20):
            writer.add(n, np.arange(n, dtype="<u4").tobytes())
        writer.close()
    with open_file(str(name)) as file:
        reader = token_frames.FrameReader(file)
        assert [len(ids) // 4 for _, ids in reader.documents()] == list(range(20))
        reader.checks[0] += 1
        with pytest.raises(ValueError, match="checksum"):
            list(reader.documents())


# ---- byte-level BPE


def expected_bpe(rows):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for doc_id, text in rows:
        ids = encoding.encode_ordinary(text)
        names = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        out.append((doc_id, len(ids), names, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


def test_bpe_query(spark, small):
    found = queries.op8_bpe_round_trip(spark, small)
    assert Counter(map(tuple, found.collect())) == expected_bpe(texts_of(small_documents(spark, small)))


def test_bpe_on_edge_rows(spark, edge):
    found = bpe_recursive.round_trip(edge).collect()
    want = expected_bpe(texts_of(edge))
    got = Counter(
        (
            r["doc_id"],
            len(r["ids"]),
            hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest(),
            hashlib.sha256(r["decoded"]).hexdigest(),
        )
        for r in found
    )
    assert got == want and all(r["same"] for r in found)


def test_bpe_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe_recursive, "CACHE_WORDS", 3)
    codec = bpe_recursive.RecursiveBpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for texts in (["one two three four"], ["four five  six\n"], [" seven", ""]):
        assert codec.decode(codec.encode(texts)) == [text.encode() for text in texts]


# ---- languages


def test_language_accuracy_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = queries.op4_byte_cnn(spark, folder).join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 150 and sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_edge_rows(spark, edge):
    model = byte_cnn.learn(edge.withColumn("lang", F.when(F.col("doc_id") < 5, "aa").otherwise("bb")), per_language=5)
    found = byte_cnn.predict(edge, model).collect()
    assert len(found) == edge.count() and {r["lang_pred"] for r in found} <= {"aa", "bb", "und"}
    assert all((r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", r["text"] or "")) for r in found)
    assert byte_cnn.learn(edge.limit(0)) is None
    assert {r["lang_pred"] for r in byte_cnn.predict(edge, None).collect()} == {"und"}
    assert byte_cnn.predict(edge.limit(0), model).count() == 0


def test_network_slopes():
    draw = np.random.default_rng(1)
    net = byte_cnn.ByteCnn(["a", "b", "c"])
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    windows, targets = draw.integers(0, 256, (5, 30)).astype(np.uint8), np.array([0, 1, 2, 0, 1])
    slopes = net._slopes(windows, targets)
    loss = lambda: -net.log_probabilities(windows)[np.arange(5), targets].mean()
    for name, place in (("conv", (3, 1)), ("bias", (2,)), ("out", (4, 1)), ("out_bias", (0,)), ("bytes", (int(windows[0, 4]), 3))):
        net.weights[name][place] += 1e-5
        up = loss()
        net.weights[name][place] -= 2e-5
        down = loss()
        net.weights[name][place] += 1e-5
        assert abs((up - down) / 2e-5 - slopes[name][place]) < 1e-4


def test_windows_cover_texts():
    texts = [bytes(range(256)) * 3, b"ab", b"x" * byte_cnn.WINDOW]
    seen = Counter()
    for windows, owners, sizes in byte_cnn.window_batches(texts):
        for window, owner, size in zip(windows, owners, sizes):
            for n in range(size - 3):
                seen[owner, bytes(window[n : n + 4])] += 1
    for owner, text in enumerate(texts):
        assert all((owner, text[n : n + 4]) in seen for n in range(len(text) - 3))


# ---- repeats


def expected_repeats(rows, length):
    first = {}
    rows = [(i, t.encode()) for i, t in rows]
    for i, text in rows:
        if i is not None:
            for p in range(len(text) - length + 1):
                w = text[p : p + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, text in rows:
        gone = np.zeros(len(text) + 1, bool)
        if i is not None:
            for p in range(len(text) - length + 1):
                if first[text[p : p + length]] < i:
                    gone[p : p + length] = True
        left = bytes(np.frombuffer(text, np.uint8)[~gone[:-1]]) if text else b""
        runs = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if text else 0
        out.append((i, len(text), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return Counter(out)


def digest_repeats(found):
    return Counter(
        (r["doc_id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
        for r in found.collect()
    )


def test_repeats_query(spark, small):
    found = queries.op6_lpf_dedup(spark, small)
    assert Counter(map(tuple, found.collect())) == expected_repeats(texts_of(small_documents(spark, small)), 50)


@pytest.mark.parametrize("seed", range(3))
def test_repeats_on_hard_texts(spark, seed):
    draw = random.Random(seed)
    base = "".join(draw.choice("abcdefgh") for _ in range(400))
    texts = [None, "", "short"]
    for _ in range(60):
        kind = draw.random()
        if kind < 0.3:
            texts.append("é" * draw.randint(0, 90) + "a" * draw.randint(0, 200))
        elif kind < 0.7:
            a = draw.randint(0, 350)
            texts.append("xyz" * draw.randint(0, 9) + base[a : a + draw.randint(20, 90)] + draw.choice("pqr") * 5)
        else:
            texts.append("".join(draw.choice("ab") for _ in range(draw.randint(0, 300))))
    df = documents(spark, texts)
    df = df.unionByName(df.where("doc_id % 7 = 0")).unionByName(df.where("doc_id = 9").withColumn("doc_id", F.lit(None)))
    for length in (20, 50):
        found = lpf_dedup.remove_repeats(df, length=length, part_bytes=2000)
        assert digest_repeats(found) == expected_repeats(texts_of(df), length)


def test_repeats_of_no_rows(spark, edge):
    assert lpf_dedup.remove_repeats(edge.limit(0)).count() == 0


# ---- secrets


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def expected_secrets(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    width = entropy_secrets.WINDOW
    for m in re.finditer(entropy_secrets.CANDIDATE, text):
        word = m[0]
        if not re.search("[0-9]", word) or not re.search("[A-Za-z]", word):
            continue
        if any(re.search(pattern, word) for pattern in entropy_secrets.ALLOWED):
            continue
        limit = entropy_secrets.HEX_LIMIT if re.fullmatch("[0-9a-fA-F]+", word) else entropy_secrets.MIXED_LIMIT
        hits = []
        for n in range(len(word) - width + 1):
            counts = Counter(word[n : n + width]).values()
            if -sum(c / width * log2(c / width) for c in counts) >= limit:
                hits.append(n)
        if hits:
            spans.append((m.start() + hits[0], 3, m.start() + hits[-1] + width))
    return sorted(spans)


def test_secret_query(spark, small):
    texts = dict(texts_of(small_documents(spark, small)))
    for row in queries.op9_entropy_secrets(spark, small).collect():
        want = expected_secrets(texts[row["doc_id"]])
        named = [f"{entropy_secrets.KINDS[k]}:{a}:{b}" for a, k, b in want]
        base = ",".join(x for x in named if not x.startswith("entropy"))
        assert row["spans"] == ",".join(named)
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in entropy_secrets.KINDS[:3]] == [sum(k == n for _, k, _ in want) for n in range(3)]


def test_secrets_on_hard_texts(spark):
    draw = random.Random(5)
    letters = entropy_secrets.ALPHABET
    texts = [
        None,
        "",
        "token=abc token = 'abcdef' Password: \"x.y=z-1\" API_KEY:=12345678 secret==abcdefg",
        "😀 AKIA" + "A1" * 9 + " AKIAshort " + "0123456789abcdef" * 3,
        "f47ac10b-58cc-4372-a567-0e02b2c3d479 some/path/of/words/and/more/12",
        "deadbeef" * 5 + "é" + "deadbeef" * 3,
        " ".join(f"token={n:08d}" for n in range(1500)),
        "Aa1" * 2000,
    ]
    texts += ["".join(draw.choice(letters + "  é") for _ in range(400)) for _ in range(20)]
    texts += [" ".join("".join(draw.choice(letters[: draw.randint(2, 66)]) for _ in range(40)) for _ in range(5)) for _ in range(20)]
    found = entropy_secrets.scan(documents(spark, texts))
    for row in found.select("text", "spans").collect():
        want = expected_secrets(row["text"] or "")
        assert [tuple(s) for s in row["spans"]] == want, row["text"][:80]
    masked = {r["doc_id"]: r["text"] for r in entropy_secrets.mask(found).collect()}
    for n, text in enumerate(texts):
        spans, left, at = expected_secrets(text or ""), [], 0
        for a, _, b in spans:
            if a > at or not left:
                left.append([a, b])
            left[-1][1] = max(left[-1][1], b)
            at = left[-1][1]
        parts, at = [], 0
        for a, b in left:
            parts += [(text or "")[at:a], "<secret>"]
            at = b
        assert masked[n] == ("".join([*parts, text[at:]]) if left else text)


def test_each_kind_is_counted_wherever_it_lies(spark, tmp_path):
    key, digits = "AKIA" + "A1" * 8, "deadbeef" * 3
    texts = [None, "", digits, f"{key} {digits}", f"{digits} token=abcdef {digits} {key} token=abcdefg", "token=abcdef " * 5]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op9_entropy_secrets(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = [s for s in expected_secrets(texts[row["doc_id"]] or "") if s[1] < 3]
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(k == n for _, k, _ in base) for n in range(3)]
        named = ",".join(f"{entropy_secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert row["base_sha256"] == hashlib.sha256(named.encode()).hexdigest()


def test_long_candidates_meet_the_allow_list(spark):
    texts = ["abcdef" * 20_000 + "1234567890", "a/" * 50_000 + "1/2", "1234567890" * 60 + "x", "word-" * 30_000 + "x1"]
    found = entropy_secrets.scan(documents(spark, texts))
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in found.collect()}
    assert [bool([s for s in spans[n] if s[1] == 3]) for n in range(2)] == [False, False]
    assert len(spans) == len(texts)


def test_a_marker_inside_a_secret_hides_nothing(spark):
    draw = random.Random(2)
    secret = "".join(draw.choice(entropy_secrets.ALPHABET[:62]) for _ in range(36))
    hidden = ["example-" + secret[:30] + "7", secret[:24] + "/xxxx/" + "9", entropy_secrets.ALPHABET, "0123456789abcdef_0123456789"]
    shown = [secret[:15] + mark + secret[15:] for mark in ("xxxx", "yyyy", "sample", "0123456789", "abcdefgh")]
    found = entropy_secrets.scan(documents(spark, hidden + shown))
    spans = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == 3] for r in found.collect()}
    assert [bool(spans[n]) for n in range(len(hidden + shown))] == [False] * len(hidden) + [True] * len(shown)


def test_a_very_long_candidate(spark):
    draw = random.Random(4)
    text = "".join(draw.choices(entropy_secrets.ALPHABET[:62], k=1_000_000))
    start = time.perf_counter()
    spans = entropy_secrets.scan(documents(spark, [text])).first()["spans"]
    assert [s["end"] - s["start"] > 999_000 for s in spans if s["kind"] == 3] == [True]
    assert time.perf_counter() - start < 60


def test_secrets_have_no_python_and_no_shuffle(spark, small):
    plan = queries.op9_entropy_secrets(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ---- similar sets


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    used = min(3, len(words))
    return frozenset(tuple(words[n : n + used]) for n in range(len(words) - used + 1))


def expected_components(rows, percent=90):
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    smallest = {}
    for n, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(n)] = min(smallest.get(find(n), doc_id), doc_id)
    # an empty set is linked with nothing
    return Counter(
        (doc_id, len(sets[n]), smallest.get(find(n)) if sets[n] else doc_id) for n, (doc_id, _) in enumerate(rows)
    )


def test_components_query(spark, small):
    found = queries.op10_group_jaccard(spark, small)
    assert Counter(map(tuple, found.collect())) == expected_components(texts_of(small_documents(spark, small)))


@pytest.mark.parametrize("block_tokens, broadcast", [(300, 0), (1 << 18, 1000)])
def test_components_of_many_near_copies(spark, monkeypatch, block_tokens, broadcast):
    """One family of near copies in many blocks, and texts that only share a passage."""
    monkeypatch.setattr(group_jaccard, "BROADCAST_CLASSES", broadcast)
    draw = random.Random(3)
    word = lambda: "w" + str(draw.randint(0, 10**9))
    family, passage = [word() for _ in range(60)], [word() for _ in range(40)]
    texts = [None, "", "one", "one two", "One  two", "a b c", "a b c d e f g h i j k l", "a b c d e f g h i j k l m"]
    for _ in range(60):
        copy = list(family)
        for _ in range(draw.randint(0, 2)):
            copy[draw.randint(0, 59)] = word()
        texts.append(" ".join(copy))
        family = copy if draw.random() < 0.3 else family
    texts += [" ".join([*passage, *[word() for _ in range(draw.randint(0, 12))]]) for _ in range(60)]
    texts += [" ".join(word() for _ in range(draw.randint(1, 9))) for _ in range(20)]
    draw.shuffle(texts)
    df = documents(spark, texts)
    df = df.unionByName(df.where("doc_id % 9 = 0"))
    found = group_jaccard.link_components(df, block_tokens=block_tokens)
    assert bag(found, "doc_id", "n_shingles", "component_id") == expected_components(texts_of(df))


@pytest.mark.parametrize("percent", [80, 90])
def test_links_lie_within_reach_of_their_first_common_token(percent):
    draw = random.Random(percent)
    ranks = np.array([draw.randint(0, 3) for _ in range(group_jaccard.SKETCH)], np.uint8)
    links = 0
    for _ in range(2000):
        base = [draw.getrandbits(64) for _ in range(draw.randint(1, 60))]
        pair = []
        for _ in range(2):
            kept = [x for x in base if draw.random() < 0.95] or base
            pair.append(np.unique(np.array(kept + [draw.getrandbits(64) for _ in range(draw.randint(0, 2))], np.uint64)))
        common = len(np.intersect1d(*pair))
        if 100 * common < percent * (len(pair[0]) + len(pair[1]) - common):
            continue
        links += 1
        lead = [list(group_jaccard.leading(tokens, ranks, percent)) for tokens in pair]
        first = next(x for x in lead[0] if x in lead[1])
        for (mine, tokens), other in zip(zip(lead, pair, strict=True), pair[::-1], strict=True):
            reach = group_jaccard.reaches(len(tokens), len(mine), percent)
            assert len(other) <= reach[mine.index(first)]
    assert links > 200


def test_far_relatives_make_few_pairs_and_sets_are_not_written(spark, monkeypatch):
    """Documents of one family, each with so many words of its own that none links to another."""
    draw = random.Random(5)
    word = lambda: "w" + str(draw.randint(0, 10**9))
    family = [word() for _ in range(200)]
    texts = []
    for _ in range(80):
        copy = list(family)
        for _ in range(9):
            copy[draw.randint(0, 199)] = word()
        texts.append(" ".join(copy))
    texts += [" ".join([*family[:-1], word()]) for _ in range(3)]
    rows = {}

    def written(df, name, old=group_jaccard._written):
        assert "tokens" not in df.columns
        found = old(df, name)
        rows.setdefault(name, []).append(found.count())
        return found

    monkeypatch.setattr(group_jaccard, "_written", written)
    df = documents(spark, texts)
    found = group_jaccard.link_components(df)
    assert bag(found, "doc_id", "n_shingles", "component_id") == expected_components(texts_of(df))
    assert len(rows["candidates"]) == 2 and max(rows["candidates"]) < 2 * len(texts)


def test_a_document_without_an_id_carries_links(spark):
    words = [f"w{n}" for n in range(40)]
    near = [" ".join(words[: 40 - n]) for n in (4, 2, 0)]  # the first and the last do not link
    rows = [(1, near[0]), (None, near[1]), (2, near[2]), (None, "some other text"), (None, "some other text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = expected_components(rows)
    assert {row[2] for row in want} == {1, None}
    assert bag(group_jaccard.link_components(df), "doc_id", "n_shingles", "component_id") == want


def test_components_of_edge_rows(spark, edge):
    assert group_jaccard.link_components(edge.limit(0)).count() == 0
    found = group_jaccard.link_components(edge)
    assert bag(found, "doc_id", "n_shingles", "component_id") == expected_components(texts_of(edge))


def least_leading(x, y, percent):
    """The fewest leading tokens that sets of these sizes share at the threshold, the tokens of one side only first."""
    common = -(-percent * (x + y) // (100 + percent))
    ends = [n - -(-percent * n // 100) + 1 - (n - common) for n in (x, y)]
    return min(ends) if common <= min(x, y) else None


@pytest.mark.parametrize("percent", [80, 90])
def test_bound_of_groups_with_mixed_sizes(spark, percent):
    assert least_leading(25, 29, 80) == 1
    rows = []
    for a_low in range(1, 62, 3):
        for a_high in range(a_low, a_low + 4):
            for b_low in range(a_low, a_high + 10):
                for b_high in range(b_low, b_low + 6):
                    pairs = [(x, y) for x in range(a_low, a_high + 1) for y in range(b_low, b_high + 1)]
                    fewest = [n for n in (least_leading(x, y, percent) for x, y in pairs) if n is not None]
                    if fewest:
                        rows.append((a_low, a_high, b_low, b_high, min(fewest)))
    df = spark.createDataFrame(rows, "a_low long, a_high long, b_low long, b_high long, common long")
    assert df.where(~group_jaccard._may_link(percent)).collect() == []
    alone = df.where("a_low = a_high and b_low = b_high").withColumn("common", F.col("common") - 1)
    assert alone.where(group_jaccard._may_link(percent)).count() == 0
