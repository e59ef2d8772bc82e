"""Every operator and stage on nulls, empty texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basewise.llm import chat, jaccard, langkernel, leaks, licenses, maintext, ngram, pieces, queries, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words int, key string, row long, n string"
LONG = " ".join(f"word{i % 700} number{i % 31}" for i in range(30_000))
COPY = " ".join(f"alpha{i} beta{i * 7 % 13}" for i in range(60))
ROWS = [
    (1, "", "en", "a", 0, 1, "x", 1, "n"),
    (2, None, "en", "a", None, 1, "x", 1, "n"),
    (3, " \n\t ", None, None, 3, None, None, None, None),
    (4, LONG, "en", "a", 1, 1, "x", 1, "n"),
    (5, COPY, "en", "a", 1, 1, "x", 1, "n"),
    (6, COPY, "en", "a", 1, 1, "x", 1, "n"),
    (6, COPY, "en", "a", 1, 1, "x", 1, "n"),
    (None, COPY, "en", "a", 1, 1, "x", 1, "n"),
    (7, "Ünïcode ﬁ K İ 漢字 🙂 \x00 </s>[INST] " + COPY[:300], "de", "a", 1, 1, "x", 1, "n"),
    (8, "The MIT License. Licensed under CC BY-NC 4.0.\nApache\nLicense mit license MIT license", "de", "a", 1, 1, "x", 1, "n"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(4, 1, 0), (5, 1, 1), (None, None, None), (6, 0, None)], "doc_id long, quality int, toxic int").write.parquet(path + "/labels.parquet")
    spark.createDataFrame([(1, COPY[50:250]), (2, None), (3, "")], "item_id long, text string").write.parquet(path + "/benchmark.parquet")
    return path


def model():
    return public_tokenizers.path(queries.PIECE_MODEL)


def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string, segment string, level int, conversation string"
    rows = [(1, 0, "user", None, "s", 1, "c"), (1, 1, "assistant", "a\\</s>\\\\[INST]", "s", 1, "c"), (None, None, None, "x", "s", 1, "c"), (2, 0, "a[/INST]b", "t\\", "s", 1, "c"), (2, 0, "a[/INST]b", "t\\", "s", 1, "c"), (3, 0, "assistant", "", "s", 1, "c")]
    got = {r["conversation"]: r for r in chat.read_back(chat.format_turns(spark.createDataFrame(rows, schema))).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\n\nassistant\na\\</s>\\\\[INST]\n") and got[1]["loss_sha256"] == sha("a\\</s>\\\\[INST]")
    assert got[1]["loss_chars"] == len("a\\</s>\\\\[INST]")
    assert got[2]["turns_sha256"] == sha("a[/INST]b\nt\\\n" * 2) and got[2]["n_turns"] == 2
    assert got[None]["turns_sha256"] == sha("\nx\n") and got[3]["loss_chars"] == 0
    assert chat.read_back(chat.format_turns(spark.createDataFrame([], schema))).count() == 0
    whole = {r["conversation"]: r for r in chat.whole(chat.format_turns(spark.createDataFrame(rows, schema))).collect()}
    assert len(whole[1]["formatted"]) == got[1]["formatted_chars"]
    (span,) = whole[1]["loss_spans"]
    masked = whole[1]["formatted"][span["start"] : span["start"] + span["length"]]
    assert chat._ESCAPED.sub(r"\1", masked) == "a\\</s>\\\\[INST]"


def test_chat_round_trip_of_any_text():
    parts = ["\\", "</s>", "[INST]", "[/INST]", "<s>", "a", "<", "|"]
    for i in range(8**4):
        text = "".join(parts[i >> 3 * k & 7] for k in range(4))
        segment, start, size, _ = chat.render(text, text)
        assert chat.parse(segment)[:2] == (text, text)
        assert chat._ESCAPED.sub(r"\1", segment[start : start + size]) == text


def test_main_text(spark):
    page = "<body><nav><a>m</a></nav><div>Site name</div><article><h1>T</h1><p>a long enough article &amp; {}<br>line</p></article><div>Subscribe now</div><div>own {}</div></body>"
    schema = "page_id long, url string, html string, text string, shared string, page long"
    rows = [(i, f"http://h/{i}", page.format(i, i), "t", "s", 1) for i in range(6)] + [(7, None, None, "t", "s", 1), (8, "http://h/1", "", "t", "s", 1), (None, "x", page.format(9, 9), "t", "s", 1), (1, "http://h/1", page.format(1, 1), "t", "s", 1)]
    got = sorted((-1 if r["page_id"] is None else r["page_id"], r["text"], r["n_chars"]) for r in maintext.extract(spark.createDataFrame(rows, schema)).collect())
    assert len(got) == len(rows)
    by = dict((k, t) for k, t, _ in got)
    assert by[0] == "T\na long enough article & 0\nline\nown 0" and by[5] == "T\na long enough article & 5\nline\nown 5" and by[7] == "" and by[8] == ""
    assert maintext.extract(spark.createDataFrame([], schema)).count() == 0


def test_main_text_keeps_copies(spark):
    pages = [(i, f"http://h/{i}", "<p>first words of the text</p><p>second part of the text</p>") for i in range(4)]
    got = maintext.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in got} == {"first words of the text\nsecond part of the text"}


def test_pieces(docs, nothing):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model())
    got = pieces.encode_texts(docs, model()).collect()
    texts = sorted((t or "") for _, t, *_ in ROWS)
    assert sorted((r["n_tokens"], r["ids"], r["decoded"]) for r in got) == sorted((len(lib.encode(t)), lib.encode(t), lib.decode(lib.encode(t)) if t else "") for t in texts)
    assert all(r["n_differ"] == 0 for r in got)
    assert pieces.encode_texts(nothing, model()).count() == 0


def words_of(text, size):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} or ({tuple(found)} if found else set())


def test_jaccard(spark, docs, nothing):
    got = jaccard.link_documents(docs, 4, 85).collect()
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: (r["n_shingles"], r["component"]) for r in got}
    assert by[6] == (len(words_of(COPY, 4)), 5) and by[5][1] == 5 and by[1] == (0, 1) and by[3] == (0, 3) and by[None][1] is None
    assert by[4] == (len(words_of(LONG, 4)), 4)
    assert jaccard.link_documents(nothing).count() == 0


@pytest.mark.parametrize("block", [10_000_000, 150])
def test_jaccard_equals_brute_force(spark, block):
    import random

    draw = random.Random(3)
    base = [[f"w{draw.randrange(400)}" for _ in range(40)] for _ in range(4)]
    rows = []
    for i in range(90):
        text = list(base[i % 4])
        for _ in range(draw.randrange(4)):
            text[draw.randrange(40)] = f"w{draw.randrange(400)}"
        rows.append((i, " ".join(text)))
    sets = [words_of(t, 3) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80, block_shingles=block).collect()
    assert {r["doc_id"]: r["component"] for r in got} == dict(enumerate(label))


def test_toxicity(spark, docs, nothing, sf_dir):
    labels = spark.read.parquet(sf_dir + "/labels.parquet")
    for table in (labels, labels.limit(0)):
        got = toxicity.score(docs, table).collect()
        assert len(got) == len(ROWS) and all(0 <= r["_score"] <= 1 for r in got)
        assert toxicity.score(nothing, table).count() == 0


def test_toxicity_grammar():
    weigh = lambda tags: toxicity.clause_score([(t, 2.0 if t in "ih" else 0.0) for t in tags])
    assert weigh("ti") > weigh("i") > weigh("ri") > weigh("ni")
    assert weigh("th") > weigh("h")
    matcher = toxicity.Matcher({"idiot$": 3.0, "lowei": 3.0})
    assert matcher.features("You idiot. Fine. so loweix!")[0] > matcher.features("not idiot")[0] > 0
    assert matcher.features("idiotic") == (0.0, 0.0, 0.0)


def test_toxicity_learns_held_out(spark):
    import random

    draw = random.Random(5)
    common = [f"wort{i}" for i in range(80)]
    common = [re.sub(r"\d", lambda m: "abcdefghij"[int(m[0])], w) for w in common]
    rows = []
    for i in range(600):
        text = [draw.choice(common) for _ in range(40)]
        if i % 4 == 0:
            for _ in range(4):
                text.insert(draw.randrange(40), draw.choice(["dummkopf", "garbagee"]))
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.score(table.select("doc_id", "text"), table.select("doc_id", "toxic"), train=F.col("doc_id") % 5 != 0).collect()
    assert all((r["_score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in got)


def test_warc(spark):
    schema = "page_id long, url string, html string, id long, digest string"
    same = "x" * 120 + "\r\n\r\nWARC/1.1\r\n\r\nü"
    rows = [(1, "http://a/1", same, 1, "d"), (2, None, same, 1, "d"), (3, "u\r\nv", None, 1, "d"), (4, "http://a/4", "", 1, "d"), (5, "http://b", "short", 1, "d"), (6, "http://b", "short", 1, "d"), (None, "n", same, 1, "d"), (7, "h", "tail\r\n\r\n", 1, "d"), (7, "h", "tail\r\n\r\n", 1, "d"), (8, "h", "a\rb\nc\r\r\n" * 40_000, 1, "d")]
    for table, want in ((spark.createDataFrame(rows, schema).repartition(3), rows), (spark.createDataFrame([], schema), [])):
        path = warc.scratch_path(spark, "test")
        warc.write_archives(table, path)
        got = warc.assemble(warc.read_records(spark, path, payloads=True)).collect()
        assert len(got) == sum(r[0] is not None for r in want)
        for r in got:
            page = int(r["metadata"]["fields"]["capture"])
            html = next(x[2] for x in want if x[0] == page) or ""
            if page == 2:
                assert r["response"]["type"] == "revisit" and r["metadata"]["fields"]["refers-to"] == "1"
            else:
                assert (r["response"]["type"], r["response"]["payload"]) == ("response", html)
            assert r["response"]["claimed_digest"] == hashlib.sha256(html.encode()).hexdigest()
            assert r["request"]["concurrent_to"] == r["response"]["record_id"]


def test_licenses(docs, nothing):
    got = licenses.scan(docs).collect()
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: r for r in got}
    r = by[8]
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ROWS[-1][1].lower())
    assert r["n_words"] == len(words) and r["n_base"] == 5 and (r["first_word"], r["last_word"]) == (1, len(words) - 2)
    assert r["base_labels"] == "apache,cc-by,mit" and r["labels"] == "apache,cc-by,cc-by-nc-4.0,mit"
    assert by[1]["n_words"] == by[2]["n_words"] == by[3]["n_words"] == 0 and by[1]["first_word"] is None and by[1]["labels"] == ""
    assert by[4]["n_words"] == 60_000
    assert licenses.scan(nothing).count() == 0


def test_licenses_wrapped_over_lines(spark):
    import textwrap

    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software"
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    rows, want = [], {}
    for label, notice in (("mit", mit), ("bsd", bsd)):
        for width in (5, 20, 50, 78):
            for lead in ("", "# ", " * "):
                for before in (0, 7, 200):
                    i = len(rows)
                    wrapped = "\n".join(lead + x for x in textwrap.wrap(notice, width, break_long_words=False))
                    rows.append((i, "int x\n" * before + wrapped + "\n\nint main" * 30))
                    want[i] = label
    # The same words far apart, one a line, are no notice.
    rows.append((len(rows), ("\n" + "x y z " * 30 + "\n").join(mit.split())))
    want[len(rows) - 1] = ""
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["labels"] for r in got} == want
    assert all((r["score"] >= 0.8) == bool(want[r["doc_id"]]) for r in got)


def test_leaks(spark, docs, nothing, sf_dir):
    items = spark.read.parquet(sf_dir + "/benchmark.parquet")
    got = leaks.mark_leaks(docs, items).collect()
    assert len(got) == len(ROWS)
    assert {r["doc_id"] for r in got if r["_leaks"]} == {5, 6, 7, None}
    assert leaks.mark_leaks(nothing, items).count() == 0
    assert all(not r["_leaks"] for r in leaks.mark_leaks(docs, items.limit(0)).collect())


def test_leaks_equal_brute_force(spark):
    import random

    draw = random.Random(8)
    letters = "abcde "
    items = [(i, "".join(draw.choice(letters) for _ in range(60))) for i in range(12)]
    rows = []
    for i in range(120):
        body = list(items[i % 12][1])
        for _ in range(draw.randrange(7)):
            body[draw.randrange(len(body))] = draw.choice(letters)
        rows.append((i, "".join(draw.choice(letters) for _ in range(80)) + "".join(body) + "".join(draw.choice(letters) for _ in range(80))))
    want = set()
    for d, text in rows:
        body = leaks.normal(text)
        for k, item in items:
            p = leaks.normal(item)
            before = [0] * (len(body) + 1)
            for i in range(1, len(p) + 1):
                now = [i]
                for j in range(1, len(body) + 1):
                    now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (p[i - 1] != body[j - 1])))
                before = now
            if min(before) <= int(0.05 * len(p)):
                want.add((d, k, min(before)))
    args = (spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    for block in (10**6, 200):
        got = leaks.mark_leaks(*args, block_chars=block).collect()
        assert {(r["doc_id"], x["item_id"], x["distance"]) for r in got for x in r["_leaks"]} == want


def test_language(docs, nothing):
    got = langkernel.identify(docs, F.lit(True)).collect()
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["lang_pred"] == by[2]["lang_pred"] == by[3]["lang_pred"] == "und" and by[4]["lang_pred"] == "en"
    assert langkernel.identify(nothing, F.lit(True)).count() == 0
    assert {r["lang_pred"] for r in langkernel.identify(docs, F.lit(False)).collect()} == {"und"}


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)} if len(words) < 2000 else None
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), hit and len(hit) or 0


def test_quality(spark, docs, nothing):
    more = spark.createDataFrame([(20, "a b c a b c A B C\n\n x\n x\n#|\n#|", "fr", "s", 1, 1, "k", 1, "n")], DOCS)
    got = ngram.judge(docs.unionByName(more)).collect()
    assert len(got) == len(ROWS) + 1
    for r in got:
        if r["text"] != LONG:
            assert tuple(r["_stats"]) == brute_counts(r["text"])
    by = {r["doc_id"]: r for r in got}
    assert by[1]["_base_failed"] and by[2]["_base_failed"] and not by[1]["_kept"] and by[5]["_kept"] and by[4]["_stats"]["n_repeat_words"] == 33_200
    assert ngram.judge(nothing).count() == 0 and ngram.judge(docs, keep_text=False).count() == len(ROWS)


def test_quality_bands_follow_each_language(spark):
    import random

    draw = random.Random(10)
    rows = []
    for lang in ("aa", "bb"):
        words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 8))) for _ in range(150)]
        for i in range(80):
            joint = "| " if i in (7, 8) else " "
            rows.append((i, joint.join(draw.choice(words) for _ in range(200)), lang))
    got = ngram.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert not any(r["_base_failed"] for r in got)
    assert {(r["lang"], r["doc_id"]) for r in got if not r["_kept"]} == {(lang, i) for lang in ("aa", "bb") for i in (7, 8)}
    found = spark.createDataFrame([("x", 1.5 + i / 1000, False) for i in range(-40, 41)], "lang string, _log_ppl double, _base_failed boolean")
    (band,) = ngram.bands(found, "lang").collect()
    assert (band["_lower"], band["_upper"]) == (pytest.approx(1.34), pytest.approx(1.66))


def test_model_sums_to_one_and_shards_agree(spark, docs):
    table = docs.select("text", F.lit("x").alias("lang"))
    whole = {r["text"]: r["_log_ppl"] for r in ngram.scored(table, ngram.train(table, "text", "lang"), "text", "lang").collect()}
    models = ngram.train(table, "text", "lang", shard_ngrams=60)
    assert len(models) > 3
    cut = {r["text"]: r["_log_ppl"] for r in ngram.scored(table, models, "text", "lang").collect()}
    assert all(whole[t] == pytest.approx(cut[t], rel=1e-6) if whole[t] is not None else cut[t] is None for t in whole)
    import numpy as np

    (model,) = ngram.train(table, "text", "lang")
    shard = ngram.ShardModel(ngram.unpack(model["model"].value["x"]), model["first"]["x"])
    symbols = model["first"]["x"][0]
    for context in ("lph", "wor", "zzz", " be"):
        stem = np.uint64(0)
        for char in context:
            stem = (stem << np.uint64(16)) | np.uint64(ord(char))
        total = np.exp(shard.log_chances((stem << np.uint64(16)) | symbols)).sum()
        assert 0.99 < total + model["first"]["x"][2] < 1.01


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages(spark, docs, nothing, sf_dir, stage):
    name, step = stage
    got = step(spark, docs, sf_dir)
    if name != "pieces":
        assert got.columns == docs.columns
    kept = sorted((r["doc_id"] or -1) for r in got.collect())
    want = {"toxicity": None, "quality": [-1, 4, 5, 6, 6, 7], "near_duplicates": [-1, 1, 2, 3, 4, 5, 7, 8], "decontamination": [1, 2, 3, 4, 8], "pieces": [-1, 1, 2, 3, 4, 5, 6, 6, 7, 8]}[name]
    if name == "quality":
        assert set(kept) <= {-1, 4, 5, 6, 7} and 5 in kept
    elif want is not None:
        assert kept == want
    assert step(spark, nothing, sf_dir).count() == 0


def test_chunks_of_pieces_at_odd_spaces_and_marks():
    import re

    import public_tokenizers

    from basewise.llm.pieces import MARK, Encoder

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        encoder = Encoder(file.read())
    library = encoder.table.library
    texts = ["", " ", "  ", "a", "a b", " a b", "a b ", "a  b", f"a{MARK}b c", MARK, f"{MARK} a", "a\tb\nc d", "é 漢 \U0001f600 x"]
    for text in texts:
        assert encoder.chunks(text) == re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK) if text else "")
    found = encoder.encode(texts)
    assert all(len(e) == 3 for f in found for e in f)
    assert [sum(len(e[1]) // 4 for e in f) for f in found] == [len(i) for i in library.encode(texts)]
    assert encoder.differed == any(e[2] for f in found for e in f)


def test_short_chunks_of_mixed_lengths_go_side_by_side():
    import public_tokenizers

    from basewise.llm.pieces import MARK, MergeTable

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        table = MergeTable(file.read())
    chunks = [MARK, f"{MARK}a", f"{MARK}the", f"{MARK}end.\nNew", f"{MARK}\U0001f600x漢", f"{MARK}\n\n", f"{MARK}tothethethethe", f"{MARK}éß$$$", MARK * 3, "\x00"]
    for some in (chunks, chunks[::-1], chunks[:1], chunks[5:6]):
        ids, counts = table.by_rounds(some)
        wanted = [table.by_heap(c) for c in some]
        assert counts.tolist() == [len(w) for w in wanted]
        assert ids.tolist() == [i for w in wanted for i in w]
