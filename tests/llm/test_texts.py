"""Operators that judge or encode single texts."""

import random
import re
import zlib
from decimal import Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import language, mixing, pieces, pii, quality, tokens

ODD = [
    "", None, " ", "\n\n \t", "12 34 ***", "x" * 3000, "a" + " " * 60 + "b", "it's I'LL 'some don't",
    "<|endoftext|> and <s> </s>", "  two  spaces ", "é日本 😀 ﬁ　x y\x1cz", "▁mark", "\x00nul", "word " * 2000,
]


def invented(seed, syllables, count):
    maker = random.Random(seed)
    words = ["".join(maker.choices(syllables, k=maker.randint(1, 4))) for _ in range(300)]
    return [" ".join(maker.choices(words, k=maker.randint(20, 120))) for _ in range(count)]


def test_language(documents):
    one = invented(1, ["th", "an", "ou", "wi", "er"], 120)
    two = invented(2, ["sch", "ü", "ung", "ei", "ver"], 120)
    langs = ["aa"] * 120 + ["bb"] * 120 + [None] * len(ODD)
    frame = documents(one + two + ODD, langs=langs)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    network = language.train(frame.where(~held))
    assert network.languages == ["aa", "bb"]
    found = {r.id: (r.lang_pred, r.score) for r in language.identify(frame, network).collect()}
    asked = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    right = [found[i][0] == langs[i] and 0.5 <= found[i][1] <= 1 for i in asked]
    assert sum(right) >= 0.97 * len(asked) and len(asked) > 30
    for i, text in enumerate(ODD, 240):
        assert (found[i] == ("und", 0.0)) == (not any(c.isalpha() for c in text or ""))
    assert {r.doc_id for r in language.confident(frame, network).collect()} >= set(range(240))


def test_texts_in_no_language_go(documents):
    langs = {"aa": ["th", "an", "ou", "wi", "er"], "bb": ["sch", "ü", "ung", "ei", "ver"]}
    texts = [t for i, parts in enumerate(langs.values()) for t in invented(i, parts, 120)]
    both = [f"{a} {b}" for a, b in zip(texts[:5], texts[120:125], strict=True)]
    maker = random.Random(6)
    junk = ["".join(maker.choices("bcdfghjklmnpqrstvwxz ", k=300)) for _ in range(5)]
    junk += ["<div class='x'><br/></div>" * 9, "日本語の文章です。これは試験です" * 5, "0x3f 12 99 {a:1};" * 9]
    long = " ".join(texts[:120]) * 20
    frame = documents(texts + both + junk + [long], langs=["aa"] * 120 + ["bb"] * 120 + [None] * 14)
    kept = language.confident(frame, language.train(frame))
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {*range(245), 253}


def looped(network, text):
    """The shares of the languages, worked out place by place."""
    data = text.lower().encode()
    total = np.zeros(len(network.output_bias))
    for start in range(0, len(data), language.WINDOW):
        part = data[start : start + language.WINDOW]
        window = part.ljust(language.WINDOW, b"\0") + b"\0" * (max(language.WIDTHS) - 1)
        pooled = []
        for k in range(network.filters.shape[1]):
            width = language.WIDTHS[k // language.FILTERS]
            best = -np.inf
            for at in range(language.WINDOW):
                seen = [v for b in window[at : at + width] for v in network.embedding[b]]
                best = max(best, float(np.dot(seen, network.filters[: len(seen), k])))
            pooled.append(max(0.0, best + network.bias[k]))
        raised = np.exp(np.array(pooled) @ network.output + network.output_bias)
        total += raised / raised.sum() * len(part)
    return total / len(data)


def test_shares_worked_out_place_by_place():
    texts = invented(3, ["th", "an"], 10) + invented(4, ["sch", "ü"], 10)
    network = language.fit(texts, ["x"] * 10 + ["y"] * 10)
    asked = ["Than Schü" * 30, "a"]
    names, scores, shares = language.judged(network, asked, np.ones(2, bool))
    for i, text in enumerate(asked):
        found = looped(network, text)
        assert names[i] == ["x", "y"][int(found[:2].argmax())]
        assert scores[i] == pytest.approx(found[:2].max(), abs=1e-4)
        assert shares[i] == pytest.approx(found[:2].sum(), abs=1e-4)


def test_language_without_labels_or_rows(documents):
    frame = documents(["some words", "12"], langs=[None, None])
    assert language.train(frame) is None
    found = language.identify(frame, None).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)] * 2
    assert [r.doc_id for r in language.confident(frame, None).collect()] == [0]
    assert language.identify(documents([]), None).count() == 0


def test_the_same_network_every_time():
    texts, names = ["ab ab ab", "cd cd", "ab", "cd cd cd"], ["x", "y", "x", "y"]
    one, two = language.fit(texts, names), language.fit(texts, names)
    assert all(np.array_equal(a, b) for a, b in zip(vars(one).values(), vars(two).values(), strict=True))


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1}
    marked = {i + j for i, w in enumerate(windows) if w in often for j in range(3)}
    lines, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in lines
            lines.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeated, len(marked)


def test_quality(spark, documents):
    maker = random.Random(3)
    good = invented(4, ["th", "an", "ou", "wi", "er"], 150)
    bad = [" ".join(w + maker.choice(["***", "%%", "&&&"]) for w in t.split()) for t in good]
    lines = ["a b c\na b c\n\n \na b c d", "x y z " * 30, "p q r p q r s t", "q\x0bw\x85e r"]
    texts = good + bad + ODD + lines
    labels = [(i, 1, 0) for i in range(0, 150, 2)] + [(i, 0, 0) for i in range(150, 300, 2)]
    labels += [(None, 1, 0), (7777, None, None), (0, 0, 0)]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = {r.id: r for r in quality.judge(documents(texts), labelled).collect()}
    for i, text in enumerate(texts):
        row = found[i]
        got = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        if i >= 290:
            assert got == base_counts(text or "")
        failed = got[0] < 50 or 100 * got[4] > 50 * got[0]
        assert row.base_failed == failed and not (failed and row.kept)
    unseen = [i for i in range(300) if i % 2 and not found[i].base_failed]
    assert all(found[i].kept == (i < 150) for i in unseen)


def test_quality_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.judge(documents(["word " + f"w{i} " * 1 for i in range(3)]), none).collect()
    assert all(r.base_failed for r in rows)
    assert quality.judge(documents([]), none).count() == 0


def test_token_counts(documents):
    from tokenizers import Tokenizer

    maker = random.Random(5)
    texts = ODD + ["".join(maker.choices("abTh eé'\n\t.,1²Ⅷ日 \x85 *", k=80)) for _ in range(300)]
    tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
    want = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]
    rows = sorted(tokens.count_tokens(documents(texts)).collect())
    assert [r.n_tokens for r in rows] == want
    assert [r.n_bytes for r in rows] == [len((t or "").encode()) for t in texts]
    assert [r.over_limit for r in rows] == [n > 512 for n in want]
    assert tokens.count_tokens(documents([])).count() == 0


def test_sentencepiece(documents):
    import sentencepiece

    maker = random.Random(6)
    texts = ODD + ["".join(maker.choices("theinga ▁\n\té日😀.,", k=70)) for _ in range(400)]
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    encoded = pieces.encode(documents(texts))
    rows = sorted(encoded.collect())
    assert [r.pieces for r in rows] == [library.encode(t or "") for t in texts]
    assert all(r.intact for r in rows)
    back = {r.id: r.text for r in pieces.decode(encoded).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}
    assert pieces.encode(documents([])).count() == 0


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    found = []
    for kind, (name, pattern) in enumerate(BASE):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            fine = {
                "email": True,
                "ip": name == "ip" and all(int(p) <= 255 for p in match[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[name]
            if fine:
                found.append((match.start(), kind, match.end()))
    return sorted(found)


def test_personal_data(documents):
    maker = random.Random(9)
    texts = ODD + [
        "a@b.c_d@e.f x@y z@w..v 日本 é@x.de", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255", "+1 (234) 555-6789 +12",
        "4111 1111 1111 1111, 4111-1111-1111-1112", "4111111111111111 5", "9" * 40000, "1 " * 30000, "a@" * 9000, "a" * 90000,
    ]
    texts += ["".join(maker.choices(list("a@.b+-() 0123456789"), k=60)) for _ in range(500)]
    texts += [f"call +1 (555) 555-{i:04d} 4111111111111111 now" for i in range(30)]
    texts += [f"at {i}.1.2.3, card 4111111111111111." for i in range(100)]
    rows = {r.id: r for r in pii.personal_data(documents(texts)).collect()}
    for i, text in enumerate(texts):
        base = base_spans(text or "")
        assert [tuple(s) for s in rows[i].base] == base
        assert set(base) <= {tuple(s) for s in rows[i].spans}
    assert pii.personal_data(documents([])).count() == 0


def test_mixing(spark, documents):
    frame = documents(["abcd" * 10] * 300, source="big").union(
        documents(["abcd" * 10] * 60, list(range(300, 360)), source="small")
    ).union(documents([None, "x"], [None, None], source=None))
    rate = {r.source: r.rate for r in mixing.rates(frame, None).collect()}
    whole = 360 * 40 + 1
    assert rate == {
        "big": pytest.approx(whole / 3 / 12000),
        "small": pytest.approx(whole / 3 / 2400),
        None: pytest.approx(whole / 3),
    }
    rows = mixing.copies(frame).select("row.*", "copy").collect()
    assert rows == mixing.copies(frame).select("row.*", "copy").collect()
    count = {s: sum(r.source == s for r in rows) for s in ("big", "small", None)}
    assert abs(count["big"] - 120) < 60 and abs(count["small"] - 120) < 60
    assert count[None] > 2 * (whole / 3) - 800
    targets = spark.createDataFrame([("big", 3.0), ("small", 0.0)], "source string, weight double")
    only = mixing.copies(frame, targets).select("row.source").distinct().collect()
    assert [r.source for r in only] == ["big"]
    assert mixing.copies(documents([])).count() == 0


@pytest.mark.parametrize("rate", [0.05, 1.0, 7.5, 400.0])
def test_poisson_inverts_its_distribution(spark, rate):
    chances = [0.0, 0.1, 0.5, 0.9, 0.999, 1 - 2**-52]
    frame = spark.createDataFrame([(c,) for c in chances], "c double")
    got = [r[0] for r in frame.select(mixing.poisson(F.lit(rate), F.col("c"))).collect()]
    for chance, count in zip(chances, got, strict=True):
        term = total = np.exp(-rate)
        k = 0
        while total <= chance and term > 0 and k < rate + 10 * rate**0.5 + 30:
            k += 1
            term *= rate / k
            total += term
        assert count == k

@pytest.mark.parametrize("rate", [499.5, 500.5, 1234.5, 80_000.25])
def test_poisson_inverts_its_distribution_at_high_means(spark, rate):
    chances = [0.0, 2**-52, 1e-9, 0.001, 0.1, 0.5, 0.9, 0.999, 1 - 1e-9]
    frame = spark.createDataFrame([(c,) for c in chances], "c double")
    got = [r[0] for r in frame.select(mixing.poisson(F.lit(rate), F.col("c"))).collect()]
    with localcontext() as exact:
        exact.prec, exact.Emin = 40, -999_999
        term = total = (-Decimal(rate)).exp()
        k, wanted = 0, []
        for chance in chances:
            while total <= Decimal(chance):
                k += 1
                term *= Decimal(rate) / k
                total += term
            wanted.append(k)
    assert got == wanted


def test_mixing_varies_at_high_means(documents):
    """Of a source with little text, documents differ as a Poisson of their rate does."""
    frame = documents(["abcd" * 5000] * 100, source="big").union(
        documents(["abcd"] * 200, list(range(100, 300)), source="small")
    )
    rate = next(r.rate for r in mixing.rates(frame, None).collect() if r.source == "small")
    assert rate > 1000
    found = mixing.copies(frame).select("row.doc_id", "row.source", "copy")
    made = found.where("source = 'small'").groupBy("doc_id").agg(
        F.count("*"), F.countDistinct("copy"), F.min("copy"), F.max("copy")
    ).collect()
    assert all(r[1] == r[2] == r[4] and r[3] == 1 for r in made)
    counts = np.array([r[1] for r in made])
    assert len(counts) == 200 and abs(counts.mean() - rate) < 5 * (rate / 200) ** 0.5
    assert 0.6 * rate < counts.var() < 1.5 * rate
