"""Cross-tokenizer alignment against brute force over whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakemart.llm import pair_bitmaps, queries
from lakemart.session import new_table_path

DOCS = "doc_id long, text string, pair string, place string, chunk string, id string"
FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def frame(spark, rows):
    """Rows with columns whose names the operator uses itself."""
    return spark.createDataFrame([(doc_id, text, "p", "q", "c", "i") for doc_id, text in rows], DOCS)


def ranges(tokens):
    end, out = 0, []
    for content in tokens:
        out.append((end, end + len(content)))
        end += len(content)
    return out


def expected(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    shown = pair_bitmaps._shown_bytes()
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def spell_a(n):
        return bytes(shown[c] for c in tokenizer.id_to_token(n))

    def spell_b(n):
        name = pieces.id_to_piece(n)
        return bytes([int(name[3:5], 16)]) if pieces.is_byte(n) else name.replace("▁", " ").encode()

    links, out, held = [], [], defaultdict(int)
    for _, text in rows:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        a_bytes, b_bytes = [spell_a(n) for n in a], [spell_b(n) for n in b]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            links.append([])
            out.append((0, 0, 0, 0, ""))
            continue
        a_ranges, b_ranges = ranges(a_bytes), ranges(b_bytes)
        own, first = [], 0
        for n, (start, end) in enumerate(a_ranges):
            while b_ranges[first][1] <= start:
                first += 1
            m = first
            while m < len(b) and b_ranges[m][0] < end:
                own.append((a[n], b[m]))
                m += 1
        ends = sorted({e for _, e in a_ranges} & {e for _, e in b_ranges})
        groups, start = [], 0
        for end in ends:
            sides = [
                ",".join(str(i) for i, (s, e) in zip(ids, spans) if start <= s and e <= end)
                for ids, spans in ((a, a_ranges), (b, b_ranges))
            ] if len(text) < 3000 else None
            groups.append("|".join(sides) if sides else "")
            start = end
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if len(text) < 3000 else None
        links.append(own)
        out.append((len(a), len(b), len(ends), len(own), sha))
        for pair in set(own):
            held[pair] += 1
    highest = defaultdict(int)
    for (a, _), count in held.items():
        highest[a] = max(highest[a], count)
    full = []
    for (doc_id, _), own, figures in zip(rows, links, out):
        best = sum(held[p] == highest[p[0]] for p in own)
        full.append((doc_id, *figures[:4], best, sum(held[p] for p in own), figures[4]))
    return full


def same(df, rows):
    found = [tuple(r) for r in df.select("doc_id", *FIGURES).collect()]
    want = expected(rows)
    blank = {(r[0], *r[1:7]) for r in want if r[7] is None}  # texts too long to group by brute force
    found = [(*r[:7], None) if r[:7] in blank else r for r in found]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def run(df, **options):
    path = new_table_path(df.sparkSession, "align")
    pair_bitmaps.build_index(df, path, **options)
    return pair_bitmaps.score_documents(df.sparkSession.read.parquet(path))


ODD = [
    "", None, " ", "  ", "a", " a", "a ", "a  b   c", "line\n\n  next\t\ttab \n end ", "It's 's don't été à la 日本語 😀 naïve",
    "see <|endoftext|> and <s> </s> <unk> <0x41>", "one▁two", "▁", "nul\x00byte", "wide　space\xa0 hard  em",
    "é  è \x85 next line", "x" * 9000, " " * 9000 + "x", "tail   ", "é combining ́ alone", "same text here",
    "same text here",
]


def test_edge_rows(spark):
    rows = [*enumerate(ODD), (20, "same text here"), (None, "no id, same text here"), (None, None)]
    same(run(frame(spark, rows)), rows)
    same(run(frame(spark, rows).coalesce(1), chunk_documents=3), rows)
    same(run(frame(spark, rows).coalesce(1), chunk_bytes=40), rows)


def test_random_texts(spark):
    pick = random.Random(11)
    parts = ["the", "of", "ing", " ", " ", "  ", "\n", "é", "ß", "\xa0", "▁", "12", "3.5", "don't", "😀", "<s>", "ция", "\t", "Ã", "-"]
    rows = [(n, "".join(pick.choices(parts, k=pick.randrange(60)))) for n in range(600)]
    same(run(frame(spark, rows)), rows)


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    same(queries.op11_pair_bitmaps(spark, small), rows)


def test_empty_table(spark):
    assert run(frame(spark, [])).count() == 0


def test_counts_of_pairs(spark):
    path = new_table_path(spark, "align")
    rows = [(1, "a a a a a"), (2, "a b"), (3, "b b"), (4, "a a")]
    pair_bitmaps.build_index(frame(spark, rows).coalesce(2), path)
    counts = pair_bitmaps.pair_counts(spark.read.parquet(path)).collect()
    found = sorted((r["documents"], r["links"]) for r in counts)
    assert found == [(2, 3), (3, 8)]
    assert all(r["best"] and r["pair"] == r["a"] << 16 | r["b"] for r in counts)


def test_bitmaps_round_trip():
    pick = np.random.default_rng(3)
    want = Counter()
    for pair in range(40):
        for place in pick.choice(3000, pick.integers(1, 2500), replace=False):
            want[pair, int(place)] = int(pick.integers(1, 40)) if pair % 2 else 1
    links = [key for key, times in want.items() for _ in range(times)]
    pairs, places = np.array(links).T
    found = Counter()
    for plane, keys, bitmaps, counts in pair_bitmaps.plane_rows(*pair_bitmaps.postings(pairs, places)):
        for pair, bitmap, count in zip(keys.tolist(), bitmaps.to_pylist(), counts.tolist(), strict=True):
            numbers = pair_bitmaps.numbers_of(bitmap).tolist()
            assert len(numbers) == count
            for number in numbers:
                found[pair, number] += 1 << max(0, plane - 1)
    assert found == want


def test_a_plane_without_documents_is_passed_over():
    pairs, places = np.array([5] * 9 + [6]), np.zeros(10, np.int64)
    assert [plane for plane, *_ in pair_bitmaps.plane_rows(*pair_bitmaps.postings(pairs, places))] == [0, 4]


@pytest.mark.parametrize("partitions", [1, 7])
def test_partitions_do_not_matter(spark, small, partitions):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    one = run(docs.repartition(partitions)).select(F.sum("n_best"), F.sum("count_sum"), F.count("*")).first()
    assert one == run(docs).select(F.sum("n_best"), F.sum("count_sum"), F.count("*")).first()
