"""Corpus operators: queries against brute force on a small table, and the odd cases that each must survive."""

import os
import random
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from frameloom.llm import chat, decontaminate, entries, jaccard, langid, packing, pii, quality, secrets, toxicity, warc  # noqa: E402
from frameloom.llm.common import components  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", None, "   \n\t ", "a", "é" * 3000, "x " * 30_000, "password=abcdefgh12345678 token: short", "\x01\x02 4111 1111 1111 1111 \x01 me@a.example.org", "a.b@c 1.2.3.4.5.6.7.8 +1 (555) 123-4567", "key b@x.y%z@w.v \U0001f600 me@mail.org"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(ODD)] + [(3, "a", "en", "s", 0), (3, "a", None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def docs(spark, tiny):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_secrets(spark, tiny, docs, odd):
    got = {r["doc_id"]: tuple(r)[1:5] for r in entries.op1_secrets(spark, tiny).collect()}
    assert got == {i: brute.secrets(t) for i, t in docs}
    found = secrets.scan(odd, secrets.fit(odd))
    assert found.count() == odd.count()
    red = {r["doc_id"]: r["text"] for r in secrets.redact(found).collect()}
    assert red[6] == "[SECRET] token: short" and red[1] is None
    assert secrets.fit(odd.limit(0)) is None
    assert secrets.scan(odd.limit(0), None).count() == 0


def test_secrets_of_any_length_and_with_late_or_no_digits_are_scored(spark):
    import random
    import string

    rnd = random.Random(3)
    made = lambda n, of=string.ascii_letters: "".join(rnd.choices(of, k=n))
    word = lambda: made(20, "aeinrst")
    both = 6 * string.ascii_letters + string.digits
    rows = [f"secret={made(rnd.randrange(30, 200), both)} {word()} {word()}" for _ in range(300)]
    hidden = [made(300, both), made(60) + made(60, both), made(48), made(130, both), made(5000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows + [f"of {h} and {word()}" for h in hidden])], "doc_id long, text string")
    red = secrets.redact(secrets.scan(docs, secrets.fit(docs))).where(f"doc_id >= {len(rows)}").orderBy("doc_id").collect()
    assert [r["text"][:-20] for r in red] == ["of [SECRET] and "] * len(hidden)


def test_secrets_learn_ordinary_runs_from_whole_texts_of_all_documents(spark):
    import random
    import string

    rnd = random.Random(4)
    made = lambda of: "".join(rnd.choices(of, k=24))
    key = lambda: made(string.ascii_letters + string.digits)
    order = lambda: made(string.digits)
    late = [f"secret={key()} {'of ' * 250}order {order()}" for _ in range(150)]
    rows = late + [f"order {made(string.ascii_uppercase)} as always" for _ in range(150)] + [f"a {key()} b" for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r["doc_id"]: [x["kind"] for x in r["secrets"]] for r in secrets.scan(docs, secrets.fit(docs)).collect()}
    assert {i: found[i] for i in range(300)} == {i: ["assign"] if i < 150 else [] for i in range(300)}
    assert sum(found[i] == ["format"] for i in range(300, 320)) >= 10


def test_automaton_learns_whole_strings():
    own = secrets.Automaton.infer(["a" * 70 + "7" * 20] * 50)
    assert own.score("a" * 70 + "7" * 20) > own.score("a" * 70 + "Z" * 20) + 1


def test_automaton_keeps_the_length_of_a_format():
    import random

    rnd = random.Random(8)
    key = lambda n: "AKIA" + "".join(rnd.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=n))
    own = secrets.Automaton.infer([key(16) for _ in range(60)])
    assert 16 <= len(own.step) <= 40
    assert min(own.score(key(16)) for _ in range(20)) > max(own.score(key(30)) for _ in range(20))


def test_secrets_of_an_unseen_format_of_a_learned_kind(spark):
    """No fixed pattern knows sk- keys without a name before them."""
    import random
    import string

    rnd = random.Random(6)
    made = lambda n, of=string.ascii_letters + string.digits: "".join(rnd.choices(of, k=n))
    rows = [f"token = sk-{made(6)}-{made(20)} and {made(12, 'aeinrst')} of order{rnd.randrange(10**6)} or {made(10, string.digits)}-{made(4, string.digits)}" for _ in range(80)]
    hidden = [f"of sk-{made(6)}-{made(20)} it" for _ in range(20)] + [f"of {made(24, 'aeinrst')} and order{rnd.randrange(10**6)} in" for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(rows + hidden)), "doc_id long, text string")
    model = secrets.fit(docs)
    assert len(model["kinds"]["assign"][0]) > 10
    found = {r["doc_id"]: [x["kind"] for x in r["secrets"]] for r in secrets.scan(docs, model).collect()}
    assert sum(found[i] == ["format"] for i in range(80, 100)) >= 18 and not any(found[i] for i in range(100, 120))


def test_a_value_of_two_kinds_teaches_both(spark):
    import random

    rnd = random.Random(4)
    digest = lambda: "".join(rnd.choices("0123456789abcdef", k=40))
    docs = spark.createDataFrame([(i, f"token={digest()} and the ordinary words around") for i in range(60)], "doc_id long, text string")
    model = secrets.fit(docs)
    assert set(model["kinds"]) == {"assign", "hex"} and len(model["kinds"]["assign"][0]) > 20
    assert model["kinds"]["assign"][0] == model["kinds"]["hex"][0]


def test_a_kind_of_one_value_finds_nothing_and_few_are_held_out_one_by_one(spark):
    one = spark.createDataFrame([(1, "password=Tr0ub4dor-and-3 or so"), (2, "Tr0ub4dor-and-4 is another")], "doc_id long, text string")
    model = secrets.fit(one)
    assert model["kinds"] == {} and [len(r["secrets"]) for r in secrets.scan(one, model).orderBy("doc_id").collect()] == [1, 0]
    three = spark.createDataFrame([(i, f"password=Tr0ub4dor-and-{i}") for i in range(3)], "doc_id long, text string")
    assert set(secrets.fit(three)["kinds"]) == {"assign"}


def test_dotted_tokens_are_whole_candidates_and_long_values_teach_nothing(spark):
    import random
    import string

    rnd = random.Random(12)
    made = lambda n: "".join(rnd.choices(string.ascii_letters + string.digits, k=n))
    dotted = lambda: f"ey{made(18)}.{made(24)}.{made(30)}"
    rows = [f"token: {dotted()} of {''.join(rnd.choices('aeinrst', k=18))} at www.some-site.example.com." for _ in range(120)]
    hidden = [f"see {dotted()}. Then" for _ in range(10)]
    docs = spark.createDataFrame([*enumerate(rows + hidden), (999, "token=" + made(200_000))], "doc_id long, text string")
    found = {r["doc_id"]: r for r in secrets.scan(docs, secrets.fit(docs)).collect()}
    assert [m[0] for m in secrets.candidates("a.b-c1234567.dd. x..y12345678 short1. 12345678", [])] == ["a.b-c1234567.dd", "y12345678"]
    spans = [[found[i]["text"][x["start"] : x["end"]] for x in found[i]["secrets"]] for i in range(120, 130)]
    whole = [[h[4:].split(". ")[0]] for h in hidden]
    assert all(s in ([], w) for s, w in zip(spans, whole, strict=True)) and sum(map(len, spans)) >= 6
    assert all([x["kind"] for x in found[i]["secrets"]] == ["assign"] for i in range(120)) and [x["kind"] for x in found[999]["secrets"]] == ["assign"]


def test_automaton_prefers_its_own_format():
    own = secrets.Automaton.infer([f"ab{i:04d}cd" for i in range(200)])
    other = secrets.Automaton.infer(["wordlike" + "x" * (i % 5) for i in range(200)])
    assert own.score("ab7777cd") > other.score("ab7777cd")
    assert own.score("wordlikexx") < other.score("wordlikexx")
    assert len(own.step) < 200


def test_warc(spark, tiny):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()]
    long = "é" * 600
    more = [(900_001, long), (900_002, long), (900_003, "tiny"), (900_004, "tiny"), (900_005, None), (900_006, "")]
    table = spark.createDataFrame([(i, "u", h) for i, h in pages + more], "page_id long, url string, html string")
    archives = warc.write_archives(warc.plan_revisits(table), warc.new_folder(spark), archive_bytes=50_000)
    got = warc.read_archives(archives)
    want = brute.warc(pages + more)
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect()} == want
    assert want[900_001][2:] == ("revisit", 900_002) and archives.count() > 1
    assert warc.read_archives(warc.write_archives(warc.plan_revisits(table.limit(0)), warc.new_folder(spark))).count() == 0


def test_warc_detects_damage():
    good = warc.record(1, "u", b"payload", __import__("hashlib").sha1(b"payload").hexdigest(), None)
    import io

    import gzip

    assert [r["payload"] for r in warc.records(io.BytesIO(good + good))] == [b"payload"] * 2
    with pytest.raises((EOFError, zlib.error)):
        list(warc.records(io.BytesIO(good[:-9])))
    for was, now in ((b"payload\r", b"paylaod\r"), (b"payload\r", b"payload2\r"), (b"WARC/1.1", b"CRAW/1.1")):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(gzip.compress(gzip.decompress(good).replace(was, now)))))
    big = b"x" * 3 * warc.BLOCK + b"\r\n\r\n"
    long = warc.record(2, "u", big, __import__("hashlib").sha1(big).hexdigest(), None)
    assert [len(r["payload"]) for r in warc.records(io.BytesIO(long + good + long))] == [len(big), 7, len(big)]


def test_decontamination(spark, tiny, docs, odd):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert _rows(entries.op3_decontaminate(spark, tiny), *cols) == sorted(brute.decontamination(docs, items))
    bench = spark.createDataFrame([(1, "X x"), (2, "É 3000"), (3, None), (4, ""), (5, "a"), (5, "a")], "item_id long, text string")
    want = sorted(x[:4] for x in brute.decontamination([(r["doc_id"], r["text"]) for r in odd.collect()], [(1, "X x"), (2, "É 3000"), (5, "a")]))
    for kw in ({}, {"broadcast_rows": 0}):
        assert _rows(decontaminate.decontaminate(odd, bench, **kw), "doc_id", "n_words", "n_hit", "n_items") == want
    assert decontaminate.decontaminate(odd, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.decontaminate(odd.limit(0), bench).count() == 0


def test_toxicity(spark, tiny, odd):
    got = entries.op4_toxicity(spark, tiny).collect()
    assert all(r["held_out"] == brute.held(r["doc_id"], 5, 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    gram = toxicity.Grammar(dict.fromkeys(toxicity.INSULTS, 1.0))
    named = lambda t: {list(toxicity.PATTERNS.values())[i] for i, v in enumerate(gram.features(t)[: len(toxicity.PATTERNS)]) if v}
    assert named("You are an idiot.") == {"insult_target"}
    assert named("He is not an idiot.") == {"insult_negated"}
    assert named("The paper said, idiot") == {"insult_reported"}
    assert named("I will destroy you") == {"threat_target"}
    assert named("idiotic scumbags") == set()
    assert named("Drop dead") == {"threat"} and named("drop it, dead wood") == set()
    assert named("an idiot at work for you") == {"insult_target"} and named("an idiot at work all day long for you") == {"insult"}
    assert named("You said he is not a clown but such a very big idiot") == {"insult_negated", "insult_reported"} and gram.features("he is not a clown")[-2] == 0
    assert len(gram.patterns.table) < 200
    labels = spark.createDataFrame([(0, 1), (1, 0), (4, None)], "doc_id long, toxic int")
    assert toxicity.score(odd, toxicity.fit(odd, labels)).count() == odd.count()
    assert toxicity.score(odd, toxicity.fit(odd, labels.limit(0))).count() == odd.count()


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.01"
    y = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = [(y[r["doc_id"]], r["predicted"]) for r in entries.op4_toxicity(spark, d).collect() if r["held_out"] and y.get(r["doc_id"]) is not None]
    toxic, clean = [p for t, p in got if t == 1], [p for t, p in got if t == 0]
    assert sum(toxic) / len(toxic) > 0.6 and sum(clean) / len(clean) < 0.03


def test_pii(spark, tiny, docs, odd):
    got = {r["doc_id"]: tuple(r)[1:6] for r in entries.op5_pii(spark, tiny).collect()}
    assert got == {i: brute.pii(t) for i, t in docs}
    table = pii.extract(odd)
    assert table.count() == odd.count()
    found = entries._span_digests(table, "entities", pii.KINDS).collect()
    assert {(r["doc_id"], *tuple(r)[1:6]) for r in found} == {(i, *brute.pii(t)) for i, t in enumerate(ODD)}
    assert pii.extract(odd.limit(0)).count() == 0


def test_pii_finds_what_shares_a_context(spark):
    cards = [n for n in range(4111111100000000, 4111111100000400) if brute.luhn(str(n))][:24]
    rows = [(i, f"account {n} here") for i, n in enumerate(cards)] + [(i, f"of {n} things and ticket{i} no") for i, n in enumerate(range(7000, 7040), 100)]
    rows += [(98, "of 98765432101 things"), (99, "account 12345678901 here"), (97, f"{'w' * 80} 12 and account 4421"), (96, "account"), (95, None)]
    rows += [(i, f"{'w' * 80} {n} x") for i, n in enumerate(cards, 200)]
    got = pii.extract(spark.createDataFrame(rows, "doc_id long, text string"))
    kinds = {r["doc_id"]: [e["kind"] for e in r["entities"]] for r in got.collect()}
    assert kinds[98] == [] and kinds[99] == kinds[97] == ["context"] and kinds[96] == kinds[95] == []
    assert all(kinds[i] == ["card"] for i in range(24)) and not any(kinds[i] for i in range(100, 140))


def test_pii_patterns_decide_for_their_own_words(spark):
    """A number that is no phone by its length is one span at most, and a value that a trusted pattern met is not marked elsewhere."""
    rows = [(i, f"call +1 (843) 555-{7000 + i} today") for i in range(40)] + [(100, "call +1 (843) 555-7672 17 today"), (101, "see +1 and +1 843 or 555-7672 there")]
    rows += [(200 + i, f"badge u{i}@a.org now") for i in range(30)] + [(300, "badge x77 now"), (301, "the word x77 here")]
    found = {r["doc_id"]: [(x["kind"], x["value"]) for x in r["entities"] if x["kind"] == "context"] for r in pii.extract(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(found[100]) <= 1 and not any(v in ("+1", "843", "17") for x in found.values() for _, v in x)
    assert found[101] == [] and found[301] == []


def test_pii_of_a_long_text_full_of_identifiers(spark):
    """60,000 addresses and numbers in one text; running values cross all blocks."""
    text = " ".join(f"u{i}@h{i % 7}.org id{i}" if i % 2 else f"10.0.{i % 256}.7 x" for i in range(60_000))
    (row,) = entries._span_digests(pii.extract(spark.createDataFrame([(1, text)], "doc_id long, text string")), "entities", pii.KINDS).collect()
    assert tuple(row)[1:6] == brute.pii(text) and row["n_email"] == row["n_ip"] == 30_000


def test_words_that_overlap_base_spans_are_seeds(spark):
    import random

    rnd = random.Random(9)
    spans = lambda n, most: [(a, a + rnd.randrange(most)) for a in (rnd.randrange(400) for _ in range(n))]
    rows = [([(*s, "v", "l") for s in spans(rnd.randrange(1, 300), 4)], spans(rnd.randrange(0, 40), 9)) for _ in range(40)]
    table = spark.createDataFrame(rows, f"words array<{pii.WORD}>, base array<struct<start:bigint,end:bigint>>")
    for r in table.select("words", "base", pii.with_seeds(table["words"], table["base"]).alias("x")).collect():
        want = sorted((w["start"], w["end"], any(b["start"] < w["end"] and w["start"] < b["end"] for b in r["base"])) for w in r["words"])
        assert sorted((x["word"]["start"], x["word"]["end"], x["seed"]) for x in r["x"]) == want


def test_packing(spark, tiny, docs):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by, seqs, total = {}, {}, 0
    for r in entries.op6_packing(spark, tiny).collect():
        by.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        total += r["length"]
    for i, text in docs:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        assert sorted(by[i]) == [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(seqs) <= 1.02 * -(-total // 1024) + 1


@pytest.mark.parametrize("text", ["a  b", " a", "a ", "a\n b", "a \n b", "\n  x  ", "don't  stop\t x", "é \u00a0 ü", "a\u2003 b", "1 2  3", "<|endoftext|> x"])
def test_words_are_encoded_as_whole_texts(text):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = packing.with_added(packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), public_tokenizers.path("byte_bpe_50k.json"))
    assert np.frombuffer(own(text), dtype="<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_added_tokens_have_their_own_ids(spark, tmp_path):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}  x", f" \n {end}\n", f"a  {end}  b don{end}'t", "<|endoftext|", f"<{end}>", f"é {end} " * 700, "plain  text", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for r in entries.op6_packing(spark, str(tmp_path)).collect():
        got.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for i, text in enumerate(texts):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        assert sorted(got[i]) == [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def test_packing_plan_places_every_rank_once():
    counts = {1024: 5, 600: 7, 424: 3, 300: 11, 100: 40, 7: 1000, 1: 3}
    used, seen = {}, {}
    for length, r0, r1, first, each, at in packing.plan(counts):
        for r in range(r0, r1):
            seen.setdefault(length, []).append(r)
            s, o = first + (r - r0) // each, at + (r - r0) % each * length
            used.setdefault(s, []).append((o, length))
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in counts.items()}
    for s in used.values():
        at = 0
        for o, length in sorted(s):
            assert o == at
            at += length
        assert at <= 1024
    assert packing.plan({}) == []


def test_quality(spark, tiny, docs, odd):
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert {r["doc_id"]: tuple(r[c] for c in cols) for r in entries.op7_quality(spark, tiny).collect()} == {i: brute.quality(t) for i, t in docs}
    got = quality.quality_rules(odd)
    assert sorted((r["doc_id"], *(r[c] for c in cols)) for r in got.collect()) == sorted((r["doc_id"], *brute.quality(r["text"])) for r in odd.collect())
    clean = "This is an ordinary sentence of a clean document. " * 1 + " ".join(f"w{i}" for i in range(60)) + "."
    rows = [(1, clean), (2, " | ".join(f"menu{i}" for i in range(40))), (3, clean + "\nAll rights reserved.")]
    kept = {r["doc_id"]: (r["kept"], r["lines_failed"]) for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {1: (True, 0), 2: (False, 1), 3: (True, 1)}


def test_chat(spark, tiny):
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    got = {r["conv_id"]: tuple(r)[1:5] for r in entries.op8_chat(spark, tiny).collect()}
    assert got == brute.chat(rows + [(-1, 0, "user", said), (-1, 1, "assistant", said)])


def test_paths_of_random_trees(spark):
    rng = random.Random(3)
    parent, score = {}, {n: rng.random() for n in range(400)}
    for n in range(400):  # one chain of 90, then trees of all depths
        parent[n] = n - 1 if 0 < n < 90 else None if n % 40 == 0 else rng.randrange(max(0, n - 12), n)

    def up(n):
        return [n] if parent[n] is None else [n, *up(parent[n])]

    best = {}
    for n in set(parent) - set(parent.values()):
        path = up(n)
        key = (-sum(score[x] for x in path), n)
        best[path[-1]] = min(best.get(path[-1], (key, path)), (key, path))
    expect = {(path[0], x, len(path) - 1 - i) for _, path in best.values() for i, x in enumerate(path)}
    nodes = spark.createDataFrame([(n, parent[n], score[n]) for n in parent], "node long, parent long, score double")
    got = [tuple(r) for r in chat.best_paths(nodes).select("path", "node", "depth").collect()]
    assert set(got) == expect and len(got) == len(expect)


@pytest.mark.parametrize("text", ["", "plain", "\\", "\\\\[INST]", "[INST] a [/INST]", "</s>", "\\</s>\\", "[REPLY]\nx\n", "a\\\n[/INST"])
def test_chat_escapes(text):
    for role in ("user", "assistant", "sys\ntem[INST]\\", None):
        piece = chat.format_turn(role, text) + chat.format_turn("user", "next")
        assert chat.read_turns(piece) == [(role or "", text, role == "assistant"), ("user", "next", False)]


def test_reply_trees(spark):
    edges = [("r", None, 0.0), ("a", "r", 1.0), ("b", "r", 5.0), ("c", "a", 1.0), ("d", "c", 9.0), ("e", "b", 1.0), ("lone", "gone", 1.0), ("x", "y", 1.0), ("y", "x", 1.0)]
    edges += [(f"n{i}", f"n{i - 1}" if i else None, 0.0) for i in range(20)]
    nodes = spark.createDataFrame(edges, "node string, parent string, score double")
    got = {}
    for r in chat.best_paths(nodes, max_rounds=8).collect():
        got.setdefault(r["path"], []).append((r["depth"], r["node"]))
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == {"d": ["r", "a", "c", "d"], "lone": ["lone"], "n19": [f"n{i}" for i in range(20)]}
    two = chat.best_paths(nodes.where("node < 'g' or node = 'r'"), keep=2)
    assert {r["path"] for r in two.collect()} == {"d", "e"}


def test_language(spark, odd):
    d = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = entries.op9_language(spark, d).collect()
    held = [(lang[r["doc_id"]], r["lang_pred"]) for r in got if r["held_out"]]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert all(r["held_out"] == brute.held(r["doc_id"], 4, 2) and 0 <= r["score"] <= 1 for r in got)
    out = {r["doc_id"]: r["lang_pred"] for r in langid.predict(odd, langid.fit(odd)).collect()}
    assert [out[i] for i in (0, 1, 2, 3)] == ["und", "und", "und", "en"]
    assert {r["lang_pred"] for r in langid.predict(odd, langid.fit(odd.limit(0))).collect()} == {"und"}


def test_language_learns_more_than_a_hundred_languages(spark):
    rows = [(k * 130 + i, f"{w}a {w}o {w}i {w}u {w}e", f"l{i:03d}") for i in range(130) for w in [f"{chr(97 + i % 26)}{chr(97 + i // 26)}{'qxzwy'[i // 26]}{chr(97 + i * 7 % 26)}"] for k in range(8 if i < 100 else 6)]
    docs = spark.createDataFrame(rows + [(10_000, "ěšč řžý áíé", "once")], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model["langs"] == [*(f"l{i:03d}" for i in range(130)), "once"]
    assert {r["lang"] for r in langid.predict(docs, model).where("lang = lang_pred").collect()} >= {f"l{i:03d}" for i in range(100, 130)}


def test_jaccard(spark, tiny, docs):
    assert _rows(entries.op10_jaccard(spark, tiny), "doc_id", "n_shingles", "component_id") == sorted(brute.components(docs))


def test_jaccard_odd_cases(spark):
    import random

    rnd = random.Random(5)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] * (k < 120) + base[k + 1 :])) for i, k in enumerate([120, 120, 60, 30, 90, 10, 119])]
    rows += [(50, None), (51, ""), (52, "one two"), (53, "ONE two"), (54, "one"), (55, " ".join(base[:60])), (56, "É a b c d e"), (57, "é a b c d e")]
    got = _rows(jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.components(rows))
    twice = spark.createDataFrame(rows[:2] + rows[:1], "doc_id long, text string")
    assert _rows(jaccard.jaccard_components(twice), "doc_id", "component_id") == [(0, 0), (0, 0), (1, 0)]
    assert jaccard.jaccard_components(twice.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 105), (105, 100)] + [(200, i) for i in range(201, 260)]
    got = dict((r["node"], r["component"]) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in (100, 101, 105)} == {100} and {got[i] for i in range(200, 260)} == {200}


def test_pipeline(spark, tiny, docs):
    import corpus_pipeline

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in entries.op7_quality(spark, tiny).where("kept").collect()}
    left = [(i, t) for i, t in docs if i in kept]
    first = {c for *_, c in brute.components(left)}
    left = [(i, t) for i, t in left if i in first]
    bad = {x[0] for x in brute.decontamination(left, items) if x[-1]}
    got = corpus_pipeline.run(spark, tiny)
    assert {r["doc_id"] for r in got.collect()} == {i for i, _ in left} - bad
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_stages_keep_rows_with_null_and_repeated_ids(spark, tiny):
    import corpus_pipeline

    text = lambda k: " ".join(f"{k}w{i}" for i in range(40))
    bad = spark.read.parquet(f"{tiny}/benchmark.parquet").where("length(text) > 100").orderBy("item_id").first()["text"]
    near = text("a") + " more"
    rows = [(None, text("n")), (None, text("m")), (None, text("a")), (7, text("b")), (7, text("c")), (7, text("c")), (8, text("a")), (9, near), (5, None), (5, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    want = [(None, text("n")), (None, text("m")), (7, text("b")), (7, text("c")), (8, text("a")), (5, None), (5, ""), (None, None)]
    assert pairs(corpus_pipeline.near_duplicate_stage(spark, docs, tiny)) == sorted(want, key=repr)
    mixed = want + [(None, bad), (7, bad), (30, bad)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in mixed], DOCS)
    assert pairs(corpus_pipeline.decontamination_stage(spark, docs, tiny)) == sorted(want, key=repr)
    assert corpus_pipeline.decontamination_stage(spark, docs.limit(0), tiny).count() == 0


def test_jaccard_large_groups_of_near_copies(spark, monkeypatch):
    """Groups whose copies differ from a common text by more and more words, so that many are just beyond its reach, a chain in which only neighbours are alike, and a passage that many texts share."""
    import random

    rnd = random.Random(11)
    word = lambda: f"w{rnd.randrange(10**6)}"
    texts = []
    for size, most in ((300, 14), (150, 8)):
        base = [word() for _ in range(90)]
        for _ in range(size):
            t = list(base)
            for _ in range(rnd.randrange(most)):
                k, what = rnd.randrange(len(t)), rnd.randrange(4)
                t[k : k + 1] = [] if not what else [word()] if what < 3 else [t[k], rnd.choice(["more", "less"])]
            texts.append(t)
    chain = [word() for _ in range(40)]
    for i in range(300):
        chain = chain[:]
        chain[i % 40] = word()
        texts.append(chain)
    passage = [word() for _ in range(30)]
    texts += [[word() for _ in range(rnd.randrange(5, 30))] + passage + [word()] for _ in range(150)]
    rnd.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(brute.components(rows))
    assert _rows(jaccard.jaccard_components(docs), "doc_id", "n_shingles", "component_id") == want
    assert len({c for *_, c in want}) > 100
    # hot differences make groups of their own, level after level, until none is left
    monkeypatch.setattr(jaccard, "NEAR_FAN", 12)
    assert _rows(jaccard.jaccard_components(docs), "doc_id", "n_shingles", "component_id") == want


def test_components_and_paths_that_do_not_end_raise(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    with pytest.raises(RuntimeError):
        components(chain, rounds=2)
    nodes = spark.createDataFrame([(f"n{i}", f"n{i - 1}" if i else None, 0.0) for i in range(20)], "node string, parent string, score double")
    with pytest.raises(RuntimeError):
        chat.best_paths(nodes, max_rounds=3)


def test_columns_of_clashing_names_keep_their_values(spark, tiny):
    """Columns named like those that the operators and stages make."""
    import corpus_pipeline

    names = ("kept", "cleaned", "n_words", "secrets", "_found", "_own", "seq", "at", "each", "_r0", "token", "doc", "key", "component_id", "spans", "w")
    line = "This is an ordinary sentence of a clean document, " + " ".join(f"w{i}" for i in range(60)) + ". password=abcdefgh12345678"
    docs = spark.createDataFrame([(1, line, "en", "s", len(line), *names), (2, line, "en", "s", len(line), *names), (3, None, None, None, None, *names)], DOCS + "".join(f", {n} string" for n in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, tiny)
        assert got.columns == docs.columns and got.count() > 0
        assert all(tuple(r[n] for n in names) == names for r in got.collect())
    assert {r["doc_id"]: r["n_chars"] for r in corpus_pipeline.secret_stage(spark, docs, tiny).collect()} == {1: len(line) - len("password=abcdefgh12345678") + len("[SECRET]"), 2: len(line) - len("password=abcdefgh12345678") + len("[SECRET]"), 3: None}
    assert corpus_pipeline.packing_stage(spark, docs, tiny).count() == 3
    for made in (toxicity.score(docs.withColumn("score", docs.n_chars), toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))), langid.predict(docs.withColumn("score", docs.n_chars), langid.fit(docs))):
        assert all(tuple(r[n] for n in names) == names and 0 <= r["score"] <= 1 for r in made.collect())
    import public_tokenizers

    cut = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for n in names:
        cut = cut.selectExpr("*", f"'{n}' as {n}")
    assert all(tuple(r[n] for n in names) == names for r in packing.pack(cut).collect())
