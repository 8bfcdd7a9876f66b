"""The corpus operators against brute force, round trips and odd tables."""

import base64
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from feedlake.llm import secret_scan
from feedlake.llm.common import read
from feedlake.llm.decontaminate import align, clean_documents, find_leaks, words_of
from feedlake.llm.html_extract import extract_pages, main_text
from feedlake.llm.jaccard_join import groups, jaccard_groups, keep_one_each
from feedlake.llm.line_crf import Field, fit_lines, judge_documents, keep_documents
from feedlake.llm.packing import OPEN, Packer, pack_documents, packing_report
from feedlake.llm.quality_qda import score_quality
from feedlake.llm.secret_scan import find_secrets, mask_secrets, secret_report
from feedlake.llm.token_files import bits_for, pack_bits, read_ids, read_token_files, token_file_report, unpack_bits, write_token_files
from feedlake.llm.tokens import byte_encoder, vocabulary_path, word_encoder
from feedlake.llm.toxicity_fm import TermCache, score_toxicity, train
from feedlake.llm.url_tree import host_and_path, judge_urls

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, label int, set string, row int"
PAGES = "page_id long, url string, html string, host string, n long"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in read(spark, SF, "documents").collect()}


def documents(spark, pairs):
    return spark.createDataFrame([(k, t, None, "s", None, 1, 0, "x", 2) for k, t in pairs], DOCS)


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (None, "no id at all here"), (6, "same row here now again more"),
    (6, "same row here now again more"), (7, "same row here now again more"), (8, "\u00a0 \u2028 \x1c é ß İ " * 3), (9, "word " * 60_000),
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    own = words(lower(text))
    return {tuple(own[k : k + 5]) for k in range(max(len(own) - 4, 1))} if own else set()


def brute_groups(pairs):
    """component of each row (None, doc_id) by comparing all pairs."""
    sets = [(k, shingles(t)) for k, t in pairs if k is not None]
    group = {k: k for k, _ in sets}

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((top(a), top(b)))
                group[high] = low
    return {k: top(k) for k in group}


def near_copies(count, seed=5):
    """Chains and clusters of edited copies, some of them only linked over others, and a shared passage."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = list(rng.choice(vocabulary, 30))
    out = []
    for _ in range(count):
        text = list(rng.choice(vocabulary, int(rng.integers(20, 90))))
        for _ in range(int(rng.integers(1, 9))):
            out.append((len(out) + 100, " ".join(text)))
            for _ in range(int(rng.integers(0, 3))):
                at = int(rng.integers(0, len(text)))
                text[at : at + 1] = [f"e{rng.integers(1000)}"] * int(rng.integers(0, 3))
        out.append((len(out) + 100, " ".join([*rng.choice(vocabulary, 12), *passage])))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_join_equals_brute_force_on_edited_copies(spark, seed):
    pairs = near_copies(40, seed)
    got = {r["doc_id"]: r for r in jaccard_groups(documents(spark, pairs)).collect()}
    want = brute_groups(pairs)
    assert {k: r["component_id"] for k, r in got.items()} == want
    assert {k: r["n_shingles"] for k, r in got.items()} == {k: len(shingles(t)) for k, t in pairs}
    assert len(set(want.values())) < len(want)


def test_join_equals_brute_force_on_the_table(spark, texts):
    got = {r["doc_id"]: r["component_id"] for r in jaccard_groups(read(spark, SF, "documents")).collect()}
    assert got == brute_groups(texts.items())


def test_rows_of_one_id_link_with_their_own_texts(spark):
    words = [f"w{k}" for k in range(60)]
    rows = [(30, " ".join(words[::-1])), (20, " ".join(words)), (20, "some other words in this row"), (10, " ".join([*words, "x"])), (10, " ".join([*words, "x"]))]
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard_groups(documents(spark, [*rows, (20, " ".join([*words[::-1], "y"]))])).collect()}
    assert set(got.values()) == {10}
    kept = keep_one_each(documents(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in kept) == [10, 30]


def test_a_large_cluster_of_near_copies_comes_together(spark):
    rng = np.random.default_rng(9)
    base = [f"w{k}" for k in range(120)]
    pairs = []
    for k in range(150):
        text = list(base)
        for at in rng.choice(120, 4, replace=False):
            text[at] = f"e{rng.integers(10**6)}"
        pairs.append((k + 1, " ".join(text)))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_groups(documents(spark, pairs)).collect()}
    assert got == brute_groups(pairs)


def test_join_of_odd_rows(spark):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_groups(documents(spark, ODD)).collect()), key=repr)
    assert [x for x in got if x[0] in (1, 2, 3)] == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]
    assert [x for x in got if x[0] in (6, 7)] == [(6, 2, 6), (6, 2, 6), (7, 2, 6)]
    assert (None, 1, None) in got or any(x[0] is None and x[2] is None for x in got)
    assert len(got) == len(ODD)
    assert jaccard_groups(documents(spark, [])).count() == 0
    kept = keep_one_each(documents(spark, ODD))
    assert kept.columns == documents(spark, ODD).columns
    assert 7 not in {r["doc_id"] for r in kept.collect()}


@pytest.mark.parametrize("bits", [26, 3])
def test_texts_are_not_shuffled_to_keep_one_of_each_group(spark, monkeypatch, bits):
    monkeypatch.setattr("feedlake.llm.jaccard_join.DROPPED_BITS", bits)  # with 3, most kept ids share their bit with a dropped one
    rows = [(k, " ".join(f"t{k // 3 if k < 45 else k}w{j}" for j in range(20))) for k in range(-60, 60)] + [(None, "no id at all here"), (99, None), (98, "")]
    groups = brute_groups([row for row in rows if row[0] is not None])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = keep_one_each(documents(spark, rows))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "text" in plan
        got = kept.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted((r["doc_id"] for r in got), key=repr) == sorted([k for k, g in groups.items() if k == g] + [None], key=repr)
    assert {(r["doc_id"], r["text"]) for r in got} <= set(rows)


def test_groups_follow_long_chains(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a long, b long")
    assert {r["id"]: r["group"] for r in groups(links).collect()} == {k: 0 for k in range(61)} | {100: 100, 101: 100}


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(name))


def ids_of(tok, text, end):
    return [*tok.encode(text or "", add_special_tokens=False).ids, end]


@pytest.mark.parametrize("name, encoder", [("byte_bpe_50k.json", byte_encoder), ("word_bpe_49k.json", word_encoder)])
def test_remembered_ids_equal_the_tokenizer(texts, name, encoder):
    tok, own = tokenizer(name), encoder()
    odd = [t for _, t in ODD[:-1]] + ["don't  Stop\n\n a\tb 12 3.5", "<|endoftext|> x", " lead", "trail ", "a\r\nb", "日本 語", "x's 're", "\u0130stanbul ſ ﬁ"]
    for text in [*texts.values(), *odd]:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == tok.encode(text or "", add_special_tokens=False).ids, text


@pytest.mark.parametrize("width", [1, 3, 8, 15, 16, 17, 31])
def test_bits_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 9001).astype(np.uint32)
    packed = pack_bits(ids, width)
    assert len(packed) == -(-9001 // 8) * width
    assert (unpack_bits(packed, width, 9001) == ids).all()
    offsets = list(range(0, len(packed), 4096 // 8 * width))
    for start, end in ((0, 0), (5, 6), (4095, 4097), (8000, 9001), (0, 9001)):
        assert (read_ids(packed, width, offsets, start, end) == ids[start:end]).all()


def test_least_bits():
    assert [bits_for(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


def test_token_files_equal_brute_force(spark, texts):
    tok, at, want = tokenizer("word_bpe_49k.json"), 0, {}
    for k in sorted(texts):
        ids = np.array(ids_of(tok, texts[k], 2), "<u4")
        want[k] = (at, len(ids), crc32(ids.tobytes()))
        at += len(ids)
    got = token_file_report(read(spark, SF, "documents").repartition(5)).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want


def test_token_files_of_odd_rows(spark, tmp_path):
    write_token_files(documents(spark, ODD), str(tmp_path / "files"))
    got = sorted(read_token_files(spark, str(tmp_path / "files")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 6, 6, 7, 8, 9]
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got][:-1]]).tolist()
    assert token_file_report(documents(spark, [])).count() == 0


def assert_packed(rows, want):
    """``rows`` of pieces hold the ids of ``want`` (doc_id -> ids) once each, in gapless sequences of at most 1024."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(want)
    for k, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            own = np.array(want[k][at : at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(want[k]), crc32(own.tobytes()))
            at += r["length"]
        assert at == len(want[k])
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    return len(by_sequence)


def test_packing_holds_every_id_once_with_little_padding(spark, texts):
    tok = tokenizer("byte_bpe_50k.json")
    want = {k: ids_of(tok, t, 0) for k, t in texts.items()}
    rows = packing_report(read(spark, SF, "documents").repartition(20)).collect()
    sequences = assert_packed(rows, want)
    total = sum(map(len, want.values()))
    assert sequences * 1024 <= 1.05 * total + 1024


def test_packing_of_odd_rows(spark):
    tok = tokenizer("byte_bpe_50k.json")
    odd = [(k, t) for k, t in ODD if k != 6]
    assert_packed(packing_report(documents(spark, odd)).collect(), {k: ids_of(tok, t, 0) for k, t in odd})
    assert packing_report(documents(spark, [])).count() == 0
    assert pack_documents(documents(spark, ODD)).where("doc_id = 6").count() == 2


def test_packer_keeps_a_bounded_number_of_windows():
    packer, rng = Packer(0), np.random.default_rng(1)
    for k in range(2000):
        n = int(rng.integers(1, 1500))
        packer.add(k, 0, n, np.zeros(n, np.uint32))
        assert len(packer.open) <= OPEN
    filled = Counter()
    for piece in packer.out:
        filled[piece[4]] += piece[2]
    assert max(filled.values()) <= 1024 and sum(filled.values()) / len(filled) > 1000


def brute_align(item, text):
    rows = np.zeros((len(item) + 1, len(text) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            rows[i, j] = max(0, rows[i - 1, j - 1] + (2 if a == b else -1), rows[i - 1, j] - 1, rows[i, j - 1] - 1)
    return rows.max()


def test_alignment_equals_the_full_matrix():
    rng = np.random.default_rng(3)
    for _ in range(60):
        item, text = rng.integers(0, 6, int(rng.integers(1, 15))), rng.integers(0, 6, int(rng.integers(1, 40)))
        score, start, end = align(item, text)
        assert score == brute_align(item, text)
        assert score == brute_align(item, text[start:end])


def test_leaks_equal_brute_force(spark, texts):
    """Every item aligned with every whole text, without seeds."""
    items = {r["item_id"]: r["text"] for r in read(spark, SF, "benchmark").collect()}
    got = {(r["doc_id"], r["item_id"]) for r in find_leaks(read(spark, SF, "documents"), read(spark, SF, "benchmark")).collect()}
    code = {}
    want = set()
    for k, text in texts.items():
        own = np.array([code.setdefault(w, len(code)) for w in words_of(text)], int)
        for i, t in items.items():
            item = np.array([code.setdefault(w, len(code)) for w in words_of(t)], int)
            if len(own) and len(item) and align(item, own)[0] >= 0.5 * 2 * len(item):
                want.add((k, i))
    assert got == want and want


def test_leaks_edited_copies_and_odd_rows(spark):
    item = [f"t{k}" for k in range(30)]
    edited = [w for k, w in enumerate(item) if k % 9 != 4]
    edited[6:6] = ["new", "words"]
    docs = documents(spark, [*ODD, (20, "a b c " * 30 + " ".join(edited).upper() + " d e" * 30), (21, " ".join(item[:9]) + " x" * 99), (22, " ".join(item))])
    bench = spark.createDataFrame([(1, " ".join(item)), (1, " ".join(item)), (2, None), (3, ""), (4, "tiny one"), (None, "zz yy xx ww vv")], "item_id long, text string")
    got = [(r["doc_id"], r["item_id"]) for r in find_leaks(docs, bench).collect()]
    assert sorted(got) == [(20, 1), (22, 1)]
    kept = clean_documents(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    mixed = documents(spark, [(20, "a clean text"), (20, " ".join(item)), (None, " ".join(item)), (None, "clean"), (3, None)])
    assert sorted(r["text"] or "" for r in clean_documents(mixed, bench).collect()) == ["", "a clean text", "clean"]
    clash = mixed.withColumn("leak", F.lit(1)).withColumn("item_id", F.lit(2))
    assert clean_documents(clash, bench).columns == clash.columns
    assert find_leaks(docs, bench.limit(0)).count() == 0
    assert find_leaks(docs.limit(0), bench).count() == 0


def test_items_with_a_common_template_and_a_hot_passage(spark):
    """Seeds join: what all items share is no seed, a passage in a third of all rows is found in each of them."""
    template = "please answer the following question about the given text"
    items = [f"{template} " + " ".join(f"i{k}w{j}" for j in range(20)) for k in range(300)]
    docs = [(k, " ".join([*(f"d{k}x{j}" for j in range(20)), items[7 if k % 3 == 0 else 8 + k % 40], "end"])) for k in range(240) if k % 3 < 2]
    docs += [(1000 + k, f"d{k} {template} y{k} z{k}") for k in range(200)] + [(0, docs[0][1]), (None, docs[0][1]), (5000, None), (5001, "")]
    bench = spark.createDataFrame([*enumerate(items), (999, "two words")], "item_id long, text string")
    got = [tuple(r)[:2] for r in find_leaks(documents(spark, docs), bench).collect()]
    want = [(k, 7 if k % 3 == 0 else 8 + k % 40) for k in range(240) if k % 3 < 2] + [(0, 7), (None, 7)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def brute_base(text):
    out = []
    for rank, (kind, pattern, ok) in enumerate((
        ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
    )):
        out += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text or "", re.ASCII) if ok(m)]
    return [x[2] for x in sorted(out)]


@pytest.mark.parametrize("every", [3, 4, 5])
def test_copies_edited_at_every_few_words(spark, every):
    """Replaced, deleted and inserted words, against the alignment of every whole text."""
    rng = np.random.default_rng(every)
    items = [[f"i{k}w{j}" for j in range(30 + k)] for k in range(8)]
    docs = []
    for k, item in enumerate(items):
        changed = [f"x{j}" if j % every == every - 1 else w for j, w in enumerate(item)]
        fewer = [w for j, w in enumerate(item) if j % every != every - 1]
        more = [w for j, w in enumerate(item) for w in ([w, "extra"] if j % every == every - 1 else [w])]
        around = [f"z{j}" for j in rng.integers(0, 500, 60)]
        docs += [(100 * how + k, " ".join([*around[:30], *body, *around[30:]])) for how, body in enumerate((changed, fewer, more))]
    bench = spark.createDataFrame([(k, " ".join(item)) for k, item in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in find_leaks(documents(spark, docs), bench).collect()}
    code = defaultdict(lambda: len(code))
    want = set()
    for k, text in docs:
        own = np.array([code[w] for w in words_of(text)], int)
        for i, item in enumerate(items):
            if align(np.array([code[w.encode()] for w in item], int), own)[0] >= 0.5 * 2 * len(item):
                want.add((k, i))
    assert got == want and len(want) >= 16


def test_base_secrets_equal_brute_force(spark, texts):
    from hashlib import sha256

    got = {r["doc_id"]: r for r in secret_report(read(spark, SF, "documents")).collect()}
    for k, text in texts.items():
        base = brute_base(text)
        assert got[k]["base_sha256"] == sha256(",".join(base).encode()).hexdigest()
        assert [got[k][f"n_{kind}"] for kind in ("assign", "access", "hex")] == [sum(b.startswith(kind) for b in base) for kind in ("assign", "access", "hex")]
        assert set(filter(None, base)) <= set(got[k]["spans"].split(","))


def test_secrets_behind_long_and_twice_compressed_streams():
    import gzip

    secret = b'password = "Kx81mmQpZ04abcd"'
    far = base64.b64encode(gzip.compress(gzip.compress(b"plain line\n" * 2_000_000 + secret))).decode()
    assert find_secrets(f"x {far} y") == ([], [(2, "assign", 2 + len(far))])
    members = base64.b64encode(gzip.compress(b"plain\n") + gzip.compress(secret)).decode()
    assert find_secrets(members) == ([], [(0, "assign", len(members))])
    cut = base64.b64encode(gzip.compress(secret * 3)[:-9]).decode().rstrip("=")  # damaged at its end
    assert find_secrets(cut)[1] == [(0, "assign", len(cut))]


def test_secrets_in_nested_layers():
    from base64 import b64encode
    from gzip import compress
    from urllib.parse import quote

    inner = "password = Zq8fK2mWx91LpT"
    twice = b64encode(b64encode(inner.encode())).decode()
    for hidden in (b64encode(inner.encode()).decode(), twice, b64encode(compress(inner.encode() * 3)).decode(), quote(twice, safe="")):
        text = f"see {hidden} there"
        _, more = find_secrets(text)
        assert any(kind == "assign" and 4 <= a < b <= 4 + len(hidden) for a, kind, b in more), hidden
    assert find_secrets("".join(f"\\u{ord(c):04x}" for c in inner))[1]
    assert find_secrets(None) == ([], [])


def test_repeated_encoded_secrets_are_found_at_each_place(spark):
    import gzip

    secret = b"password = Zq8fK2mWx91LpT"
    plain, packed = base64.b64encode(secret).decode(), base64.b64encode(gzip.compress(secret)).decode()
    nested = base64.b64encode(plain.encode()).decode()
    escaped = "%70assword=Zq8fK2mWx91LpT"
    runs = [plain, packed, nested, plain, escaped, packed, nested, plain, escaped]
    text = " \n".join(runs)
    want, at = set(), 0
    for run in runs:
        want.add((at, "assign", at + len(run)))
        at += len(run) + 2
    base, more = find_secrets(text)
    assert want <= set(base + more)
    got = mask_secrets(documents(spark, [(1, text)])).first()["text"]
    assert got == " \n".join(["[assign]"] * len(runs))


def test_secrets_in_any_alignment_line_or_container():
    import gzip
    import textwrap
    import zlib
    from urllib.parse import quote

    secret = b"password = Zq8fK2mWx91LpT"
    plain, noise = base64.b64encode(secret).decode(), np.random.default_rng(1).bytes(300)
    long = base64.b64encode(gzip.compress(noise + b"\n" + secret)).decode()
    packed = gzip.compress(secret), zlib.compress(secret)
    hidden = [f"{start}{plain}" for start in ("/path/", "key-", "id_", "x/")]
    hidden += ["\n".join(textwrap.wrap(long, n)) for n in (64, 76)] + ["/a/" + base64.b64encode(packed[0]).decode()]
    hidden += [base64.b64encode(odd + secret + odd).decode() for odd in (b"\0", b"\xc2\xa0", b"\xe2\x80\x8b", b"\xff")]
    for data in packed:
        hidden += [quote(data, safe=""), "".join(f"%{x:02x}" for x in data), repr(data)[2:-1], "".join(f"\\x{x:02x}" for x in data), "".join(f"\\u{x:04x}" for x in data)]
    for run in hidden:
        more = find_secrets(f"see {run}\nmore words there")[1]
        assert any(kind == "assign" and 4 <= a < b <= 4 + len(run) for a, kind, b in more), run
    assert find_secrets("a_long_identifier_of_a_program\nword\n" + base64.b64encode(noise).decode()) == ([], [])


@pytest.mark.parametrize("width", [4, 7, 20, 60, 64])
def test_secrets_wrapped_at_any_width(width):
    import gzip
    import textwrap

    run = base64.b64encode(gzip.compress(b"one line of text\npassword = Zq8fK2mWx91LpT")).decode()
    text = "A key follows.\n" + "\n".join(textwrap.wrap(run, width)) + "\nThat was all of it."
    more = find_secrets(text)[1]
    assert [(text[a:b].replace("\n", ""), kind) for a, kind, b in more] == [(run, "assign")]


def test_secrets_at_every_place_around_the_end_of_a_window(monkeypatch):
    """Wrapped base64 and plain secrets inside a stream that is scanned in small windows."""
    import gzip
    import textwrap

    monkeypatch.setattr(secret_scan, "WINDOW", 2000)
    secret = b"password = Zq8fK2mWx91LpT"
    inner = "\n".join(textwrap.wrap(base64.b64encode(gzip.compress(bytes(range(256)) + b"\n" + secret)).decode(), 64)).encode()
    for before in range(1300, 2300, 37):
        for body in (inner, secret):
            lines = (b"some plain words\n" * 200)[: before - 1] + b"\n"
            run = base64.b64encode(gzip.compress(lines + body + b"\nthe end.\n" + b"more words\n" * 300)).decode()
            assert find_secrets(f"{run} x")[1] == [(0, "assign", len(run))], before


def test_long_lines_are_scanned_in_parts_that_overlap(monkeypatch):
    import gzip

    for name, size in (("WINDOW", 1000), ("HELD", 4000), ("OVERLAP", 200)):
        monkeypatch.setattr(secret_scan, name, size)
    for before in range(3900, 4100, 9):
        run = base64.b64encode(gzip.compress(b"~" * before + b"password = Zq8fK2mWx91LpT" + b"~" * 9000)).decode()
        assert find_secrets(run)[1] == [(0, "assign", len(run))], before


def test_long_runs_and_bombs_end_soon(spark):
    import gzip
    import time

    began = time.monotonic()
    run = base64.b64encode(np.random.default_rng(2).bytes(700_000)).decode()
    assert find_secrets(run) == ([], [])
    assert find_secrets("abcdefgh\n" * 100_000 + "end") == ([], [])
    assert find_secrets("%" + "25" * 100_000 + "41")[1] == find_secrets("\\" + "u005c" * 100_000)[1] == []
    assert find_secrets("password%" + "25" * 5000 + "3DKx81mmQpZ04abcd")[1]
    zeros = gzip.compress(bytes(80 << 20))
    bomb = base64.b64encode(gzip.compress(zeros)).decode()
    docs = documents(spark, [(1, f"a {bomb} b"), (2, "plain")])
    got = {r["doc_id"]: (r["spans"], r["n_unopened"]) for r in secret_report(docs).collect()}
    assert got == {1: ("", 1), 2: ("", 0)}
    assert [r["text"] for r in mask_secrets(docs).orderBy("doc_id").collect()] == ["a [unopened] b", "plain"]
    assert time.monotonic() - began < 60


def test_masking_keeps_rows_and_columns(spark):
    docs = documents(spark, [*ODD, (30, "token: abcdefghijkl99 end")])
    got = mask_secrets(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    assert got.where("doc_id = 30").first()["text"] == "[assign] end"


def test_rule_counts_equal_brute_force(spark, texts):
    field = Field(np.zeros((11, 2)), np.zeros((2, 2)))
    got = {r["doc_id"]: r for r in judge_documents(read(spark, SF, "documents"), field).collect()}
    for k, text in texts.items():
        own, seen, dup = words(text), set(), 0
        for line in filter(words, (text or "").split("\n")):
            dup += line in seen
            seen.add(line)
        windows = list(zip(own, own[1:], own[2:]))
        counts = Counter(windows)
        repeats = len({j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 3)})
        want = (len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, repeats)
        r = got[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_viterbi_finds_the_best_labelling():
    from itertools import product

    rng = np.random.default_rng(4)
    field = Field(rng.normal(size=(11, 2)), rng.normal(size=(2, 2)))
    for n in range(1, 8):
        x = rng.normal(size=(n, 11))
        score = x @ field.emit

        def total(path):
            return sum(score[k, s] for k, s in enumerate(path)) + sum(field.step[a, b] for a, b in zip(path, path[1:]))

        assert total(field.labels(x)) == pytest.approx(max(map(total, product((0, 1), repeat=n))))


def test_rules_on_odd_tables(spark):
    docs = documents(spark, ODD)
    field = fit_lines(docs, spark.createDataFrame([], LABELS))
    got = judge_documents(docs, field)
    assert got.count() == len(ODD)
    assert keep_documents(docs, field).columns == docs.columns
    assert judge_documents(docs.limit(0), field).count() == 0


@pytest.mark.parametrize("score, label, least", [(score_quality, "quality", 0.9), (score_toxicity, "toxic", 0.9)])
def test_held_out_accuracy(spark, score, label, least):
    sf = "/root/testdata/sf0.01"
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    rows = score(docs, labels).where("held_out").join(labels, "doc_id").select("score", label).collect()
    ones, zeros = ([r["score"] for r in rows if r[label] == k] for k in (1, 0))
    area = np.mean([(a > b) + (a == b) / 2 for a in ones for b in zeros])
    assert area >= least
    odd = score(documents(spark, ODD), spark.createDataFrame([(4, 1, None), (None, 0, 1)], LABELS)).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)
    assert score(documents(spark, []), labels.limit(0)).count() == 0


def test_terms_that_are_toxic_only_together():
    """Each of two terms is as frequent in clean as in toxic texts; they are clean one by one."""
    rng, cache = np.random.default_rng(1), TermCache()
    pairs = [["groupe", "insulte"], ["groupe"], ["insulte"], []]
    texts = [" ".join([*rng.choice([f"w{k}" for k in range(300)], 25), *pairs[k % 4]]) for k in range(1600)]
    toxic = np.array([k % 4 in (0, 3) for k in range(1600)], int)
    machine = train([np.array(cache.terms(t)) for t in texts[:1200]], toxic[:1200], 0.5)
    known = TermCache(machine.known)
    right = [(machine.score(known.terms(t)) >= 0.5) == y for t, y in zip(texts[1200:], toxic[1200:])]
    assert np.mean(right) > 0.9


def test_main_text():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><article><h1>Head &amp; line</h1>"
        "<p>First  paragraph, with\n commas, and more words than a menu has, certainly.</p><script>var a = '<p>no</p>'</script>"
        "<p>Second &eacute; paragraph, long enough to score, too.</p></article><div class=comments><p>Nice post, thanks a lot, really.</p></div>"
        "<footer>(c)</footer></body></html>"
    )
    want = "Head & line\nFirst paragraph, with commas, and more words than a menu has, certainly.\nSecond é paragraph, long enough to score, too."
    assert main_text(page) == want
    assert main_text(None) == main_text("") == ""


def test_main_text_keeps_all_of_several_articles():
    page = (
        "<body><ul><li><a href=x>Home</a></ul><article><p>One, two, three and a longer text here.</p><ul><li><a href=y>see also this</a></ul></article>"
        "<article><p title=it's data-x='a>b'>Second, part, of the text here too.</p><div class='meta-analysis'>The studies, all of them.</div>"
        "<div class='post-meta'>by someone</div></article><article class=ad><p>Buy this, now, at once, all of it.</p></article></body>"
    )
    want = ["One, two, three and a longer text here.", "see also this", "Second, part, of the text here too.", "The studies, all of them."]
    assert main_text(page).split("\n") == want


def test_deep_trees_with_stray_ends_take_linear_time():
    import time

    began = time.monotonic()
    main_text("<font>" * 20000 + "</b>" * 20000 + "<div>x</div>" * 5000)
    assert time.monotonic() - began < 10


def test_pages_of_odd_rows(spark):
    odd = [(1, None, None, None, 1), (None, "x", "<p", "h", 2), (1, None, None, None, 1), (3, "://", "<div>" * 3000 + "deep", "h", 3)]
    pages = spark.createDataFrame(odd, PAGES)
    got = extract_pages(pages).collect()
    assert len(got) == 4 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert extract_pages(pages.limit(0)).count() == 0
    assert judge_urls(pages).count() == 4
    assert judge_urls(pages.limit(0)).count() == 0


def test_url_rules(spark):
    urls = [
        ("https://A.Example.com/en/x?y", "a.example.com", "/en/x", "example.com/en/", "block"),
        ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("x://b.net/fr/1#z", "b.net", "/fr/1", "net/fr/", "block"), ("http://q.com/", "q.com", "/", "com/", "allow"),
        ("http://notnet/es/", "notnet", "/es/", None, "allow"), ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(k, u[0], None, None, 0) for k, u in enumerate(urls)], PAGES)
    got = sorted(judge_urls(pages).collect(), key=lambda r: r["page_id"])
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == [u[1:] for u in urls]
    assert host_and_path is not None


def test_templates_reject_what_no_rule_names(spark):
    """Alike siblings share the labels of one, at an inner level; unlike and unlabelled ones keep out of it."""
    rules = (("block", "h.net", "/a/"), ("block", "s.net", "/bad/x/"), ("allow", "s.net", "/ok/"))
    urls = [f"http://h.net/{part}/{k}" for part in "ab" for k in range(40)]
    urls += [f"http://h.net/c/{k}.html" for k in range(40)] + [f"http://o.net/b/{k}" for k in range(40)]
    urls += [f"http://s.net/ok/{k}" for k in range(3000)]  # the bad section has 2 % of this host
    urls += [f"http://s.net/bad/{part}/{k}.html" for part in "xy" for k in range(30)]
    pages = spark.createDataFrame([(k, u, None, None, 0) for k, u in enumerate(urls)], PAGES)
    got = {urls[r["page_id"]]: (r["rule"], r["verdict"]) for r in judge_urls(pages, rules).collect()}
    want = {"h.net/a": "block", "h.net/b": "block", "h.net/c": "allow", "o.net/b": "allow", "s.net/ok": "allow", "s.net/bad/x": "block", "s.net/bad/y": "block"}
    for start, verdict in want.items():
        assert {v for u, (_, v) in got.items() if u.startswith(f"http://{start}/")} == {verdict}, start
    assert got["http://h.net/b/1"] == got["http://s.net/bad/y/1.html"] == (None, "block")


def test_pipeline_applies_its_stages(spark, texts):
    import corpus_pipeline

    docs, kept = read(spark, SF, "documents"), None
    field = fit_lines(docs, read(spark, SF, "labels"))
    kept = {r["doc_id"] for r in judge_documents(docs, field).where("kept").collect()}
    component = brute_groups([(k, texts[k]) for k in kept])
    kept = {k for k in kept if component[k] == k}
    leaks = {r["doc_id"] for r in find_leaks(docs, read(spark, SF, "benchmark")).collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == kept - leaks
    assert "pipeline" in __spark_entry__.queries()


def test_queries_have_their_columns(spark):
    want = {"op7_decontamination": ["doc_id", "item_id"], "op9_jaccard_join": ["doc_id", "n_shingles", "component_id"]}
    for name, columns in want.items():
        assert __spark_entry__.queries()[name](spark, SF).columns[: len(columns)] == columns


def test_sets_below_the_limit_are_not_paired_across_groups(spark, monkeypatch):
    """Copies of one text that all miss the limit: the lists are long, and sketches keep their pairs from being made."""
    from feedlake.llm import jaccard_join

    rng = np.random.default_rng(11)
    base = [f"w{k}" for k in range(150)]
    pairs = []
    for k in range(120):
        text = list(base)
        for at in rng.choice(150, 5, replace=False):
            text[at] = f"e{rng.integers(10**6)}"
        pairs.append((k + 1, " ".join(text)))
        pairs.append((k + 1001, " ".join([*text, "x"])))
    made = {}

    def noted(session, df, label, landed=jaccard_join.landed):
        out = landed(session, df, label)
        made.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "landed", noted)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_groups(documents(spark, pairs)).collect()}
    assert got == brute_groups(pairs)
    assert len(set(got.values())) > 10
    assert made["join-pairs"][-1] <= len(pairs)


def test_small_tables_of_the_join_are_landed_by_few_tasks(spark, monkeypatch):
    """Where Spark joins no small partitions, a table of a few rows is not written as a file for each partition."""
    from feedlake.llm import jaccard_join

    rng, pairs, files = np.random.default_rng(12), [], {}
    for k in range(60):
        text = [f"g{k % 20}w{j}" for j in range(40)]
        text[int(rng.integers(40))] = f"e{k}"
        pairs.append((k + 1, " ".join(text)))

    def noted(session, df, label, landed=jaccard_join.landed):
        out = landed(session, df, label)
        files[label] = max(files.get(label, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(jaccard_join, "landed", noted)
    held = {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in held}
    for name, value in held.items():
        spark.conf.set(name, value)
    try:
        got = {r["doc_id"]: r["component_id"] for r in jaccard_groups(documents(spark, pairs)).collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == brute_groups(pairs)
    assert {"join-classes", "join-lists", "join-known", "join-groups"} <= set(files)
    assert max(files.values()) <= 2 * spark.sparkContext.defaultParallelism


def test_large_batches_reach_a_step_in_parts(spark):
    from feedlake.llm.common import BATCH_BYTES, map_lists

    def make():
        return lambda rows: {"doc_id": rows["doc_id"], "n": [sum(map(len, rows["text"]))] * len(rows["doc_id"])}

    docs = spark.range(300, numPartitions=1).selectExpr("id as doc_id", "repeat('x', if(id = 150, 6000000, 60000)) as text")
    got = map_lists(docs, make, "doc_id long, n long").collect()
    assert [r["doc_id"] for r in got] == list(range(300))
    assert max(r["n"] for r in got[:100]) <= BATCH_BYTES < 300 * 60_000


def test_encoders_are_dropped_by_tasks_that_do_not_encode():
    from feedlake.llm import tokens

    first = tokens.byte_encoder()
    assert tokens.byte_encoder() is first
    ids = first.ids("some words to remember")
    tokens.forget()
    assert not tokens.byte_encoder.cache_info().currsize
    assert tokens.byte_encoder().ids("some words to remember") == ids


def test_sketches_never_differ_in_more_bits_than_sets():
    from feedlake.llm.jaccard_join import _sketch

    rng = np.random.default_rng(4)
    for n in (1, 30, 500, 5000):
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[: int(rng.integers(0, n + 1))], rng.integers(0, 2**63, n // 5).astype(np.uint64)]))
        bits = sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(_sketch(x), _sketch(y)))
        assert bits <= len(np.setxor1d(x, y))


def test_packing_sends_what_it_holds_before_a_batch_ends():
    """A batch of many long documents goes out in several parts, in the same order as at once."""
    import pyarrow as pa

    from feedlake.llm import packing

    class Fixed:
        def ids(self, text):
            return np.arange(3000, dtype="<u4").tobytes()

    rows = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(["x"] * 1000)], names=["doc_id", "text"])
    sent = list(packing.packed_batches([rows], Packer(0), Fixed(), True))
    sizes = [sum(b.column(2).to_pylist()) for b in sent]
    assert sum(sizes) == 1000 * 3001
    assert len(sizes) > 1 and max(sizes) < packing.SENT_IDS + 4 * 1024
