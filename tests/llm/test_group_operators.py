"""Near-duplicates, chats, WARC records and the pipeline."""

from __future__ import annotations

import random
import re
import zlib
from itertools import combinations, product

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import chat, neardup, warc
from millrace.llm.encode import Encoder, tokenizer_path
from millrace.llm.links import components

from .samples import no_docs, odd_docs, odd_texts, prose


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words)} if 0 < len(words) < k else {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def plain_groups(texts, k):
    sets = [shingles(t, k) for t in texts]
    root = list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root[a], root[b]))
            root = [x if r == y else r for r in root]
    return root, [len(s) for s in sets]


def copies(n, seed):
    """Texts that are edited step by step, copies, and others."""
    r = random.Random(seed)
    out = []
    for g in range(n):
        words = prose(r.randint(20, 120), 1000 * seed + g).split()
        for _ in range(r.randint(1, 14)):
            out.append(" ".join(words))
            for _ in range(r.randint(0, 3)):
                words[r.randrange(len(words))] = r.choice(["zu", "zi", "za"]) + str(r.randrange(99))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("limits", [(256, 4 << 20, 32 << 20), (3, 2000, 1000)])
def test_near_duplicates(spark, limits, monkeypatch):
    for name, limit in zip(("BLOCK", "BLOCK_BYTES", "STAR_BYTES"), limits, strict=True):
        monkeypatch.setattr(neardup, name, limit)
    texts = copies(25, 5) + odd_texts()
    got = neardup.groups(odd_docs(spark, texts), k=4).dropDuplicates(["doc_id"]).collect()
    root, sizes = plain_groups(texts, 4)
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (sizes[r.doc_id], root[r.doc_id], root[r.doc_id] == r.doc_id), r
    assert len(set(root)) < len(texts) - 40


def test_near_duplicates_of_repeated_ids(spark):
    """Rows that share a doc_id, or have none, are judged each by its own text."""
    texts = copies(30, 8)
    ids = [i // 3 for i in range(len(texts))]
    rows = [*zip(ids, texts, strict=True), (None, texts[0]), (None, texts[0]), (0, None), (1, "")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, tag string")
    root, sizes = plain_groups(texts, 4)
    least = {r: min(ids[i] for i in range(len(texts)) if root[i] == r) for r in set(root)}
    got = sorted((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.groups(docs, k=4).collect() if r.doc_id is not None)
    assert got == sorted([(False, ids[i], sizes[i], least[root[i]], ids[i] == least[root[i]]) for i in range(len(texts))] + [(False, 0, 0, 0, True), (False, 1, 0, 1, True)])
    root, _ = plain_groups(texts, 5)
    least = {r: min(ids[i] for i in range(len(texts)) if root[i] == r) for r in set(root)}
    kept = {(ids[i], texts[i], "x") for i in range(len(texts)) if ids[i] == least[root[i]]}
    cleaned = neardup.clean(docs, k=5)
    assert cleaned.columns == docs.columns
    order = lambda x: tuple(str(v) for v in x)
    assert sorted(map(tuple, cleaned.collect()), key=order) == sorted([*kept, (None, texts[0], "x"), (None, texts[0], "x"), (0, None, "x"), (1, "", "x")], key=order)


def test_near_duplicates_of_nothing(spark):
    assert neardup.groups(no_docs(spark), k=5).count() == 0
    lone = neardup.groups(odd_docs(spark, [None, "", "a"]), k=5).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in lone} == {(0, 0, True), (1, 1, True), (2, 2, True)}


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(120), r.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 340)] + [(5, None), (7, 7)]
    root = {x: x for pair in links for x in pair if x is not None}
    for a, b in [p for p in links if None not in p] * 60:
        root[a] = root[b] = min(root[a], root[b])
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: root[n] for n in got} and {n for n in root if root[n] != n} <= set(got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def least_cost(roles):
    """All role choices, by brute force."""
    best = None
    for choice in product(chat.ROLES, repeat=len(roles)):
        cost, last = 0, "start"
        for own, new in zip(roles, choice, strict=True):
            gap = chat._between(last, new)
            ways = [] if gap is None else [chat.INSERT * len(gap)]
            ways += [chat.MERGE] if last == new else []
            if not ways:
                cost = None
                break
            label = (own or "").strip().lower()
            cost += min(ways) + (0 if label == new else chat.RELABEL if label in chat.ROLES else chat.UNKNOWN)
            last = new
        if cost is not None:
            cost += chat.INSERT * len(chat._between(last, None))
            best = cost if best is None else min(best, cost)
    return best


LEGAL = re.compile(r"(<\|system\|>\n.*?<\|end\|>\n)?(<\|user\|>\n.*?<\|end\|>\n<\|assistant\|>\n.*?<\|end\|>\n)+", re.S)


def test_role_repair_is_cheapest(spark):
    r = random.Random(4)
    chats = [[r.choice(["user", "assistant", "system", "tool", None, "User "]) for _ in range(r.randint(1, 6))] for _ in range(60)]
    rows = [(c, t, role, None if t == 3 else f"text {c} {t}") for c, roles in enumerate(chats) for t, role in enumerate(roles)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"fragment": F.lit(1), "block": F.lit("x"), "start": F.lit(2)})
    got = {}
    for x in chat.repair(table).collect():
        got.setdefault(x.conv_id, []).append(x)
    for c, roles in enumerate(chats):
        own = sorted(got[c], key=lambda x: x.turn)
        assert len(own) == len(roles) and own[0].block_cost == least_cost(roles), roles
        assert LEGAL.fullmatch("".join(x.fragment for x in own)), "".join(x.fragment for x in own)


def test_blocks_of_a_huge_conversation(spark, monkeypatch):
    r = random.Random(6)
    roles = [r.choice(["user", "assistant", "system", "bot"]) for _ in range(300)]
    table = spark.createDataFrame([(7, t, role, str(t)) for t, role in enumerate(roles)] + [(8, 0, "user", "x"), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    whole, total = chat.path(roles, 0, None)
    monkeypatch.setattr(chat, "BLOCK", 16)
    monkeypatch.setattr(chat, "FAN", 3)
    rows = chat.repair(table).collect()
    own = sorted((x for x in rows if x.conv_id == 7), key=lambda x: x.turn)
    costs = {x.turn // 16: x.block_cost for x in own}
    assert len(own) == 300 and sum(costs.values()) == total and len(whole) == 300
    text = "".join(x.fragment for x in own)
    assert LEGAL.fullmatch(text) and re.findall(r"\d+", text) == [str(t) for t in range(300)]
    assert len(rows) == 302
    assert chat.repair(table.limit(0)).count() == 0


def test_blocks_of_one_turn_number(spark, monkeypatch):
    """A conversation without an id whose rows nearly all bear one turn number, in parts."""
    r = random.Random(8)
    turns = sorted([(5, r.choice(["assistant", "bot", "system", "user"]), f"{i:03d}") for i in range(200)] + [(5, "user", "x" * 50_000)] * 3 + [(1, "user", "a"), (9, "tool", "z")])
    _, total = chat.path([role for _, role, _ in turns], 0, None)
    monkeypatch.setattr(chat, "BLOCK_ROWS", 7)
    monkeypatch.setattr(chat, "FAN", 4)
    rows = chat.repair(spark.createDataFrame([(None, *t) for t in turns] + [(1, 0, "user", "q")], "conv_id long, turn long, role string, text string").repartition(3)).collect()
    own = [x for x in rows if x.conv_id is None]
    assert len(own) == len(turns) and len(rows) == len(turns) + 1
    inserts = sum(len(x.inserted) for x in own)
    cost = sum(chat.MERGE * ("merge" in x.action) + (0 if "relabel" not in x.action else chat.RELABEL if x.role in chat.ROLES else chat.UNKNOWN) for x in own) + chat.INSERT * inserts
    assert cost == total

def test_warc_derivatives(spark):
    html = '<html lang="FR"><head><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script></head><body><h1>H &lt;1&gt;</h1><p>one <b>two</b><br>three</p><!-- no --><a href="/x">é</a></body></html>'
    pages = spark.createDataFrame([(1, "http://a.b/c d", html), (2, None, None), (3, "u", "<<a <script>never closed"), (4, "u", "plain & <"), (1, "http://a.b/c d", html)], "page_id long, url string, html string")
    pages = pages.withColumns({"record": F.lit(0), "record_id": F.lit("x")})
    responses = warc.responses(pages)
    derived = warc.derivatives(responses).collect()
    source = {r.page_id: warc.parse(r.record) for r in responses.collect()}
    assert len(derived) == 10
    for page, record in derived:
        headers, block = warc.parse(record)
        assert headers["WARC-Refers-To"] == source[page][0]["WARC-Record-ID"] and headers["WARC-Target-URI"] == source[page][0]["WARC-Target-URI"]
        assert headers["WARC-Refers-To-Payload-Digest"] == source[page][0]["WARC-Payload-Digest"] and headers["WARC-Payload-Digest"] == warc.digest(block)
        if page == 1 and headers["WARC-Type"] == "conversion":
            assert block.decode() == "H <1>\none two\nthree\né"
        if page == 1 and headers["WARC-Type"] == "metadata":
            assert "title: A & B\r\n" in block.decode() and "language: fr\r\n" in block.decode() and "http-header: Content-Type: text/html" in block.decode()
    described = warc.describe(warc.derivatives(responses)).collect()
    assert len(described) == 10 and {r.warc_type for r in described} == {"metadata", "conversion"}
    assert warc.describe(warc.derivatives(warc.responses(pages.limit(0)))).count() == 0
    with pytest.raises(ValueError):
        warc.parse(derived[0].record.replace(b"http-status", b"http-stateX"))


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as P

    good = [prose(60, i) for i in range(40)]
    bad = ["".join(w + "### " for w in prose(60, 100 + i).split()) for i in range(20)]
    item = prose(30, 900)
    texts = good + bad + [good[3], good[4] + " more", prose(50, 901) + " " + item, prose(40, 902) + ' token = "abcdef1234567890"', None, "short"]
    docs = odd_docs(spark, texts, clashes=False)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 40)) for i in range(60)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in P.STAGES] == ["quality rules", "near-duplicates", "benchmark leaks", "secret scans", "packing"]
    now, kept = odd_docs(spark, texts), []
    for _, stage in P.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path)).cache()
        assert set(docs.columns) <= set(now.columns)
        kept.append({r.doc_id for r in now.collect()})
    # By brute force: rules, then groups of five-word shingles, then the leak.
    first = {i for i, t in enumerate(texts) if i < 40 or i in (60, 61, 62, 63)}
    root, _ = plain_groups([t if i in first else None for i, t in enumerate(texts)], 5)
    second = {i for i in first if root[i] == i}
    assert kept == [first, second, second - {62}, second - {62}]
    assert now.where("contains(text, 'abcdef1234567890')").isEmpty() and now.where("doc_id = 63 and contains(text, '[secret]')").count() == 1
    result = P.run(spark, str(tmp_path)).collect()
    # Its pieces hold each kept text's ids, masked, and the end id, each once.
    masked = {r.doc_id: r.text for r in now.collect()}
    assert masked[63] == texts[63].replace('token = "abcdef1234567890', "[secret]") and all(masked[i] == texts[i] for i in masked if i != 63)
    tokenizer, expected = Encoder(tokenizer_path()), set()
    for i, text in masked.items():
        ids, at = [*tokenizer.whole(text).tolist(), 0], 0
        for bit in [1024] * (len(ids) // 1024) + [1 << k for k in range(9, -1, -1) if len(ids) % 1024 >> k & 1]:
            expected.add((i, at, bit, zlib.crc32(np.array(ids[at : at + bit], "<u4").tobytes()), len(ids), 0))
            at += bit
    assert {(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.offset) for r in result} == expected and {r[0] for r in expected} == kept[-1]
    assert len({r.sequence_id for r in result}) == len(result) == len(expected)
    for _, stage in P.STAGES:
        assert stage(spark, no_docs(spark), str(tmp_path)).count() == 0
