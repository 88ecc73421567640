"""Every operator on fixtures with nulls, empty and long texts, ties, repeated rows, clashing columns, and empty tables."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import differences
from pyspark.sql import functions as F

import __spark_entry__ as contract
from fleetfeatures.llm import chat, html, linededup, minhash, mixing, mtree, packing, quality, suffix, tokencounts
from fleetfeatures.llm.common import shared_path, table
from fleetfeatures.llm.tokens import BytePairCounter, WordTokenizer, tokenizer_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "ba be bi bo bu da de di do du fa fe fi fo fu".split()
WORD_FILE, RANK_FILE = tokenizer_file("word_bpe_49k.json"), tokenizer_file("byte_bpe_50k.tiktoken")


def _prose(seed: int, n: int) -> str:
    dice = random.Random(seed)
    return " ".join("".join(dice.choices(WORDS, k=dice.randint(1, 4))) for _ in range(n)) + "."


def _odd_rows() -> list[tuple]:
    """Copies, near copies, shared passages, a very long text, nulls and blanks in every column, repeated ids and rows."""
    a, b, shared = _prose(1, 120), _prose(2, 150), _prose(3, 60)
    words = a.split()
    rows = [
        (1, a, "en", "s1", len(a)), (2, a, "en", "s2", len(a)), (2, a, "en", "s2", len(a)),
        (3, " ".join([*words[:60], "changed", *words[61:]]), "en", "s1", 1), (4, b, "fr", None, None),
        (5, f"{b[:40]}\n{shared}\n{_prose(4, 30)}", None, "s1", 1), (6, f"{_prose(5, 80)}\n{shared}", "en", "s3", 1),
        (7, f"{_prose(6, 80)}\n{shared[:-2]}x.", "en", "s3", 1), (7, _prose(7, 20), "en", "s3", 1),
        (None, _prose(8, 70), "en", "s1", 1), (None, None, None, None, None), (8, "", "en", "s1", 0),
        (9, None, "en", "s1", None), (10, " \n\t\n ", "en", "s2", 5), (11, "aaaa" * 200, "en", "s2", 800),
        (12, "one two", "en", "s2", 7), (13, "one two", "en", "s2", 7), (14, "\n".join(_prose(20 + i, 12) for i in range(400)), "de", "s4", 1),
        (15, "日本語のテキスト。 é̂ ﬁ <|endoftext|> 😀 it's I'LL 12³", "ja", "s5", 1),
        (16, "HOME | MENU | ABOUT | NEWS\nAll rights reserved.\n" + _prose(9, 90), "en", "s1", 1),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_odd_rows(), DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def _clashing(df):
    """The same rows with further columns whose names operators might use."""
    for name in ("row", "words", "key", "place", "bucket", "open", "line", "plan_source", "digest", "size", "body", "runs"):
        df = df.withColumn(name, F.lit("x"))
    return df


def _rows(df) -> Counter:
    return Counter(map(tuple, df.collect()))


# queries against their SQL -----------------------------------------------------------------------------------------

OPS = sorted(n for n in contract.queries() if n.startswith("op"))


def test_all_operators_and_the_pipeline_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in OPS) == list(range(1, 14))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", [n for n in OPS if n in contract.oracle_sql()])
def test_query_equals_sql(spark, sf, name):
    assert differences(contract.queries()[name](spark, sf), contract.oracle_sql()[name], sf) is None


def test_sql_forms_on_odd_rows(spark, docs, tmp_path):
    for name in ("documents", "labels", "embeddings", "conversations"):
        {"documents": docs,
         "labels": spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int"),
         "embeddings": _vectors(spark).withColumn("label", F.when(F.col("vec_id").isNull() | (F.col("vec_id") % 9 != 4), F.coalesce(F.col("vec_id") % 3, F.lit(1)).cast("int"))),
         "conversations": _turns(spark)}[name].coalesce(1).write.parquet(str(tmp_path / f"_{name}"))
        next((tmp_path / f"_{name}").glob("*.parquet")).rename(tmp_path / f"{name}.parquet")
    for other in ("region nation customer supplier part orders lineitem events pages benchmark").split():
        (tmp_path / f"{other}.parquet").symlink_to(f"/root/testdata/sf0.001/{other}.parquet")
    for name in (n for n in OPS if n in contract.oracle_sql()):
        assert differences(contract.queries()[name](spark, str(tmp_path)), contract.oracle_sql()[name], str(tmp_path)) is None, name


def test_empty_tables(spark, nothing, tmp_path):
    assert quality.quality_report(nothing).count() == mixing.mix(nothing).count() == linededup.line_report(nothing).count() == 0
    assert suffix.repeat_report(nothing).count() == minhash.class_report(nothing).count() == 0
    assert packing.pack_documents(nothing, WORD_FILE).count() == 0
    assert tokencounts.maintained_counts(nothing, shared_path(spark)).count() == 0
    assert html.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert mtree.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.build_packs(turns, RANK_FILE), RANK_FILE).count() == 0


def test_clashing_columns(docs):
    wide = _clashing(docs)
    assert _rows(quality.quality_report(wide)) == _rows(quality.quality_report(docs))
    assert _rows(linededup.line_report(wide)) == _rows(linededup.line_report(docs))
    assert _rows(suffix.repeat_report(wide)) == _rows(suffix.repeat_report(docs))
    assert _rows(minhash.class_report(wide)) == _rows(minhash.class_report(docs))
    assert _rows(mixing.mix(wide.drop("size").withColumn("size", F.lit("x")))) == _rows(mixing.mix(docs))
    for stage in (quality.clean_documents, linededup.dedup_lines, minhash.keep_one, mixing.mix_rows):
        out = stage(wide)
        assert out.columns == wide.columns
        assert _rows(out.select(docs.columns)) == _rows(stage(docs))


# 1 HTML ------------------------------------------------------------------------------------------------------------

PAGES = {
    "": "",
    "<p>": "",
    "plain words": "plain words",
    "<html><head><title>t</title><style>p{}</style><script>var a='<p>no</p>';</script></head><body><nav><ul><li><a href=x>Menu</a>"
    "</ul></nav><div class='ad'>Buy this thing now, really do.</div><article><h1>A &amp; B</h1><p>First <b>bo</b>ld\n  text.<p>Next &eacute;&#33;"
    "<ul><li>one<li>two</ul><aside>Side note</aside></article><footer>&copy; All</footer>": "A & B First bold text. Next é! one two",
    "<body><header>Site</header><div id=content><h2>Head</h2><p>Some long enough text stands here to be the article.</p>"
    "<form>Name <input name=q><button>Send</button></form><p>Tail.</p></div><section class='comments'><article><p>I disagree with all of this at length,"
    " indeed with every word.</p></article></section><div class='cookie-notice'>We use cookies</div>":
    "Head Some long enough text stands here to be the article. Tail.",
    "<main><p>a</p><!-- hidden --><p hidden>b</p><div style='display: none'>c</div><p>d<br>e</p></main>": "a d e",
}


def test_html(spark):
    pages = [(i, f"u{i}", h) for i, h in enumerate(PAGES)] + [(99, None, None), (100, "u", "<p>" + "x " * 300000)]
    out = {r.page_id: r for r in html.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert [out[i].text for i in range(len(PAGES))] == list(PAGES.values())
    assert out[99].text == "" and out[99].n_chars == 0 and out[100].n_chars == 599999
    assert html.smoothed([0.0, 0.0, 9.0, 0.0, 0.0])[2] == max(html.smoothed([0.0, 0.0, 9.0, 0.0, 0.0]))


# 2 mixing ----------------------------------------------------------------------------------------------------------

def test_mixing_targets_and_repeats(spark, sf):
    rows = mixing.mix(table(spark, sf, "documents")).collect()
    total, by = sum(r.size for r in rows), defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert r.taken % max(1, r.size) == 0 and r.taken <= 2 * r.size
    assert abs(sum(v[0].target for v in by.values()) - 1.5 * total) < 1e-6 * total
    for v in by.values():
        assert v[0].target <= 2 * v[0].source_size == 2 * sum(r.size for r in v)
        assert abs(sum(r.taken for r in v) - v[0].target) <= max(r.size for r in v)
    again = mixing.mix(table(spark, sf, "documents").repartition(3))
    assert _rows(again) == Counter(map(tuple, rows))


def test_heavier_documents_come_first(spark):
    sources = [(i, _prose(i, 10), "en", "a" if i % 4 else "b", 1) for i in range(2000)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(2000)], "doc_id long, quality int, toxic int")
    taken = Counter()
    for r in mixing.mix(spark.createDataFrame(sources, DOCS), labels).collect():
        taken[r.doc_id % 2, r.source] += r.taken
    assert taken[1, "a"] > 1.15 * taken[0, "a"]


# 3 token counts ----------------------------------------------------------------------------------------------------

def test_token_counts(spark, docs):
    want = Counter()
    counter = BytePairCounter(RANK_FILE)
    for _, text, lang, source, _ in _odd_rows():
        want[source, lang, "docs"] += 1
        want[source, lang, "tokens"] += len(counter.ids(text or ""))
    got = tokencounts.maintained_counts(docs, shared_path(spark)).collect()
    assert {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in got} == {
        k[:2]: (want[(*k[:2], "docs")], want[(*k[:2], "tokens")]) for k in want}


def test_rollup_is_idempotent_and_signed(spark):
    counts = spark.createDataFrame([("a", "en", "v", 5, 7), ("a", "en", "v", 3, 3), ("b", None, "v", 2, 2)],
                                   "source string, lang string, tokenizer string, tokens long, better long")
    rollup = tokencounts.Rollup(spark, shared_path(spark))
    assert rollup.totals().count() == 0
    assert rollup.commit("1", tokencounts.inserts(counts)) and not rollup.commit("1", tokencounts.inserts(counts))
    assert rollup.commit("2", tokencounts.revisions(counts, "tokens", "better"))
    want = {("a", "en", "v", 2, 10), ("b", None, "v", 1, 2)}
    assert {tuple(r) for r in rollup.totals().collect()} == want
    rollup.compact()
    assert not rollup.commit("2", tokencounts.inserts(counts)) and {tuple(r) for r in rollup.totals().collect()} == want
    assert rollup.commit("3", tokencounts.deletes(counts.filter("source = 'b'")))
    rollup.compact()
    assert {tuple(r) for r in rollup.totals().collect()} == {("a", "en", "v", 2, 10)} and rollup.committed() == {"1", "2", "3"}


# 5 long repeats ----------------------------------------------------------------------------------------------------

def _repeats(texts: list[str | None]) -> list[tuple]:
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[q:q + 200] for b in bodies for q in range(len(b) - 199))
    out = []
    for b in bodies:
        gone = np.zeros(len(b) + 1, bool)
        for q in range(len(b) - 199):
            if seen[b[q:q + 200]] > 1:
                gone[q:q + 200] = True
        gone = gone[:-1]
        runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(gone) else 0
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_long_repeats(docs, batches):
    want = Counter((r[0], *v) for r, v in zip(_odd_rows(), _repeats([r[1] for r in _odd_rows()])))
    assert _rows(suffix.repeat_report(docs, batches)) == want


def test_long_repeats_with_many_contexts(spark, monkeypatch):
    """A passage in many documents, and near copies: keys with many contexts take the counted way."""
    passage, base = _prose(50, 60), _prose(51, 200).split()
    texts = [f"{_prose(100 + i, 25)} {passage} {_prose(300 + i, 25)}" for i in range(60)]
    texts += [" ".join([*base[:k], "zz", *base[k + 1:]]) for k in range(0, 200, 4)]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    want = Counter((i, *v) for i, v in enumerate(_repeats(texts)))
    assert _rows(suffix.repeat_report(frame)) == want
    monkeypatch.setattr(suffix, "TOGETHER", 3)
    assert _rows(suffix.repeat_report(frame)) == want


def test_pieces_give_the_anchors_of_the_whole(monkeypatch):
    text = _prose(60, 4000).encode()
    whole = suffix.anchors([(text, 0, len(text))])
    monkeypatch.setattr(suffix, "PIECE", 3000)
    found = set()
    for _, start, piece, first, end in suffix.cut([text]):
        _, p, low, high, key, context = suffix.anchors([(piece, first, end)])
        found |= set(zip((p + start).tolist(), low.tolist(), high.tolist(), key.tolist()))
    assert found == set(zip(*(x.tolist() for x in whole[1:5])))


# 6 near copies -----------------------------------------------------------------------------------------------------

def _classes(texts: list[str | None]) -> list[int]:
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    at = list(range(len(texts)))

    def top(i: int) -> int:
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] == sets[j] or both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                at[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(texts))]


@pytest.mark.parametrize("small", [32, 1])
def test_near_classes(spark, monkeypatch, small):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "RARE", 4 if small == 1 else 12)
    base = _prose(70, 200).split()
    texts = [r[1] for r in _odd_rows()]
    texts += [" ".join([*base[:k], "zz", *base[k + 1:]]) for k in range(0, 200, 5)]
    dice = random.Random(5)
    for n in range(2, 40, 2):  # at all distances from the base, some links only by way of others
        texts.append(" ".join(w if dice.random() > n / 200 else f"y{n}" for w in base))
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    assert {r.doc_id: r.class_id for r in minhash.class_report(frame).collect()} == dict(enumerate(_classes(texts)))
    assert sorted(r.doc_id for r in minhash.keep_one(frame).collect()) == sorted(set(_classes(texts)))


def test_dart_signatures_estimate_weighted_similarity():
    dice = np.random.default_rng(3)
    x = dice.integers(1, 2 ** 62, 300).astype(np.uint64)
    for n, (w, v) in enumerate([(np.ones(300), np.ones(300)), (dice.integers(1, 5, 300).astype(float), dice.random(300) * 4)]):
        a, b = minhash.dart_signature(x[:240], w[:240], 2000), minhash.dart_signature(x[60:], v[60:], 2000)
        both, either = np.minimum(w[60:240], v[60:240]).sum(), w[:60].sum() + v[240:].sum() + np.maximum(w[60:240], v[60:240]).sum()
        assert abs((a == b).mean() - both / either) < 0.04, n


# 7 top-k -----------------------------------------------------------------------------------------------------------

def _vectors(spark):
    dice = random.Random(1)
    rows = [(i, [dice.gauss(0, 1) for _ in range(8)]) for i in range(150)]
    rows += [(i, rows[3][1]) for i in range(150, 200)]  # ties
    rows += [(50, rows[7][1]), (None, rows[3][1]), (201, None), (202, [1.0, None]), (203, [float("nan")] * 8),
             (204, [float("inf")] * 8), (250, []), (300, [0.5, 2.0])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_top_k_prunes_and_stays_exact():
    dice = np.random.default_rng(2)
    centres = dice.normal(size=(30, 16)) * 300
    x = np.floor(np.repeat(centres, 100, axis=0) + dice.normal(size=(3000, 16)) * 20)
    top = float((x * x).sum(axis=1).max())
    page = mtree.Page(np.arange(3000), x, top)
    for q in x[::500]:
        best = sorted(((-int(s), i) for i, s in enumerate(x @ q) if i != 7))[:5]
        assert sorted((-s, i) for s, i in page.search(q, 7, 5, top, float("-inf"))) == best


# 8 packing ---------------------------------------------------------------------------------------------------------

def _pieces(rows: list[tuple]) -> Counter:
    from tokenizers import Tokenizer
    library, out = Tokenizer.from_file(WORD_FILE), Counter()
    for doc_id, text, *_ in rows:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            out[doc_id, n, at, len(part), zlib.crc32(part.tobytes())] += 1
    return out


def test_packing(docs):
    rows = packing.pack_documents(docs, WORD_FILE).collect()
    assert Counter(tuple(r)[:5] for r in rows) == _pieces(_odd_rows())
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for v in places.values():
        ends = [0, *np.cumsum([n for _, n in sorted(v)]).tolist()]
        assert [o for o, _ in sorted(v)] == ends[:-1] and ends[-1] <= 4096
    assert len(places) == -(-sum(r.length for r in rows) // 4096)


def test_genetic_search_betters_best_fit():
    lengths = [6, 5, 5, 4, 4, 3, 3, 3, 3, 2, 2] * 3  # sums to 12 bins of 10
    bins: packing.Bins = []
    packing.best_fit([7, 6, 3, 2, 2], list(range(5)), bins, 10)
    assert sorted(map(len, bins)) == [2, 3]
    best = packing.evolve(lengths, [], 1, 10, generations=500)
    assert sorted(i for b in best for i in b) == list(range(33)) and all(sum(lengths[i] for i in b) <= 10 for b in best)
    assert len(best) == 12


def test_fast_ids_are_the_librarys():
    fast, dice = WordTokenizer(WORD_FILE), random.Random(1)
    letters = "abcdeéñß0123456789 '’.,!?ſÉÀTHEtheing\n\t—…«»½²ªǅƏ_-$%&|x日😀́"
    texts = ["".join(dice.choices(letters, k=dice.randrange(60))) for _ in range(3000)] + [r[1] or "" for r in _odd_rows()]
    for text in texts:
        assert np.frombuffer(fast.ids(text), "<u4").tolist() == fast.library.encode(text, add_special_tokens=False).ids


# 9 chat ------------------------------------------------------------------------------------------------------------

def _turns(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes </s> & &amp; &#60; [ROLE]x[/ROLE]"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"),
            (3, 0, "user", "hi"), (3, 1, "assistant", "no"), (3, 2, "user", None), (4, 1, "assistant", ""), (4, 0, None, "é😀"),
            (5, None, "system", "<<SYS>> <|x|>"), (5, 3, "user", "a"), (5, 3, "user", "a"), (None, 0, "assistant", "lost"), (6, 0, "assistant", "x" * 50000)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_shared_turns_are_written_once(spark):
    rows = chat.build_packs(_turns(spark).coalesce(1), RANK_FILE).collect()
    leaves = sum(len(r.leaves) for r in rows)
    nodes = sum(len(r.parents) for r in rows)
    assert leaves == 7 and nodes < 14
    for r in rows:
        for n, parent in enumerate(r.parents):
            assert r.position_ids[r.starts[n]] == (r.position_ids[r.ends[parent] - 1] + 1 if parent >= 0 else 0)
            assert sum(b - a for a, b in zip(r.intervals[n][::2], r.intervals[n][1::2])) == r.position_ids[r.ends[n] - 1] + 1


def test_escaping_is_reversible():
    for text in ["", "&", "&amp;", "&#60;", "</s>[INST] ok [/INST]", "<<<s>s>", "&#38;#60;", "[ROLE][/ROLE]<|im|>"]:
        assert chat.unescape(chat.escape(text)) == text
        assert not any(mark in chat.escape(text) for mark in chat.CONTROL)


# 10 lines ----------------------------------------------------------------------------------------------------------

def _edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_lines(spark):
    dice, base = random.Random(4), [_prose(400 + i, 6) for i in range(12)]
    lines = []
    for k in range(260):
        line = dice.choice(base)
        for _ in range(dice.choice([0, 1, 1, 2])):
            at, how = dice.randrange(len(line)), dice.random()
            line = line[:at] + ("" if how < 0.3 else dice.choice("xyz")) + line[at + (how < 0.7):]
        lines.append(line)
    texts = ["\n".join([*lines[i:i + 4], "", "short"]) for i in range(0, 260, 4)] + [None, "", "\n"]
    seen: list[str] = []
    want = []
    for text in texts:
        here = []
        for line in (text or "").split("\n"):
            if not line.strip():
                here.append(line)
            elif line not in seen:
                if len(line) < 20 or not any(len(s) >= 20 and abs(len(s) - len(line)) < 2 and _edits(s, line) == 1 for s in seen):
                    here.append(line)
                seen.append(line)
        want.append("\n".join(here))
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r.text for r in linededup.dedup_lines(frame).collect()}
    assert [got[i] or "" for i in range(len(texts))] == want
    report = {r.doc_id: r for r in linededup.line_report(frame).collect()}
    for i, text in enumerate(want):
        assert report[i].n_chars_left == sum(len(x) for x in text.split("\n") if x.strip())


# the pipeline ------------------------------------------------------------------------------------------------------

def test_pipeline_stages(spark, sf, tmp_path):
    import corpus_pipeline
    docs = table(spark, sf, "documents")
    kept = {r.doc_id for r in quality.quality_report(docs).collect() if r.kept}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        if number < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "quality_rules":
            assert {r.doc_id for r in after} == kept and all(r.n_chars == len(r.text) for r in after)
        elif name == "line_dedup":
            seen = Counter(line for r in after for line in r.text.split("\n") if line.strip())
            assert len(before) == len(after) and max(seen.values()) == 1
            assert set(seen) <= {line for r in before for line in r.text.split("\n")}
        elif name == "near_dedup":
            before.sort(key=lambda r: r.doc_id)
            assert sorted(r.doc_id for r in after) == sorted(before[i].doc_id for i in set(_classes([r.text for r in before])))
        elif name == "source_mixing":
            times = Counter(r.doc_id for r in after)
            for r in mixing.mix(spark.createDataFrame(before, docs.schema)).collect():
                assert r.size == 0 or times[r.doc_id] * r.size == r.taken
        else:
            assert Counter(tuple(r)[:5] for r in after) == _pieces([(r.doc_id, r.text) for r in before])
