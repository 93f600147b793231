"""Page text, chat formatting, decontamination and token counts against plain versions."""

import hashlib
import re
import time

import pytest
from fixtures import documents, empty, texts

from larder.llm import chat, html_text, phrases, token_counts
from larder.session import checkpoint_dir

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_main_text_leaves_out_what_surrounds_an_article():
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=x>Menu</a></nav>
      <div class="cookie-notice">We use cookies, many cookies, to track whatever you read on this site</div>
      <div class="page has-sidebar"><article><h1>Head &amp; more</h1><p>First   paragraph with enough words in it.<p>Be.</p>
      <p>A <b>bold</b> word<br>and &eacute;nd.</p><aside>Aside</aside><form>Name <input></form><script>var a="</p>"</script>
      <div class="ad-slot">Buy now</div></article></div><div id="sidebar"><p>Side text that goes on and on</p></div>
      <section class="comments"><p>A reader's long comment about the article above, longer than the article</p></section><footer>&copy;</footer></body></html>"""
    assert html_text.main_text(page) == "Head & more\n\nFirst paragraph with enough words in it.\n\nBe.\n\nA bold word and énd."
    assert html_text.main_text("<p>a <span class=ad>buy</span> b<p>c") == "a b\n\nc"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>x</nav>") == ""
    assert html_text.main_text("plain") == "plain"
    assert html_text.main_text("<p>a one</p><![foo[ x ]]><p>b") == "a one\n\nb"
    assert html_text.main_text("<p>q</p><![%x;[").startswith("q")
    began = time.process_time()
    assert html_text.main_text("<div>x" * 20_000).count("x") >= 18_000  # the box that holds nearly all
    assert html_text.main_text("<div>" * 20_000 + "</section>" * 20_000 + "x") == "x"
    assert html_text.main_text("<div><article>" * 10_000 + "x") == "x"
    assert time.process_time() - began < 10
    long = "<article>" + "<p>" + "word " * 50_000 + "</p><p>end</article>"
    assert html_text.main_text(long).endswith("word\n\nend")


def test_main_text_keeps_every_section():
    long, short = "word " * 400, "more " * 30
    page = f"<body><nav><a href=x>Menu</a></nav>{{}}<h1>T</h1><section><p>{long}</p></section><section><p>{short}</p><ul><li>one<li>two</ul></section>{{}}<footer>f</footer></body>"
    want = "\n\n".join(["T", long.strip(), short.strip(), "one", "two"])
    for begin, end in (("<article>", "</article>"), ("<main>", "</main>"), ("<div>", "</div>"), ("<div><div><p>Lead</p></div><div>", "</div></div>")):
        got = html_text.main_text(page.format(begin, end))
        assert got == ("Lead\n\n" if "Lead" in begin else "") + want, begin
    listed = "".join(f"<p><a href=x>Another story {i}</a></p>" for i in range(5))
    assert html_text.main_text(f"<body><div>{listed}</div><div><h1>T</h1><div><p>{long}</p></div></div></body>") == f"T\n\n{long.strip()}"


def test_main_text_keeps_body_text_in_boxes_with_noisy_names():
    long, short = ("word " * 300).strip(), "a few words of it"
    for name in ("class='elementor-widget elementor-widget-text-editor'", "class='content with-sidebar'", "class='legal-text'", "id=discussion", "class=layout-right-sidebar", "class=sidebar"):
        assert html_text.main_text(f"<body><nav>Menu</nav><div {name}><p>{long}</p></div><footer>f</footer></body>") == long, name
    page = f"<body><nav>Menu</nav><div id=c><section><p>{long}</p></section>{{}}</div></body>"
    for name in ("id=discussion", "class='legal-text'", "class=related"):
        assert html_text.main_text(page.format(f"<section {name}><p>{short}</p></section>")) == f"{long}\n\n{short}", name
    linked = "".join(f"<li><a href=x>Another story {i}</a>" for i in range(9))
    for box in (f"<div class=related-posts><ul>{linked}</ul></div>", f"<div class=post-sidebar><ul>{linked}</ul></div>", f"<div class=comments><p>{long}</p></div>", f"<div class=ad-slot><p>{short}</p></div>", f"<div class=cookie-notice><p>{short}</p></div>"):
        assert html_text.main_text(page.format(box)) == long, box
    assert html_text.main_text(f"<body><div class=comments><p>{long}</p></div></body>") == ""


def test_main_text_leaves_out_short_boxes_in_the_article():
    long, sentence = ("word " * 300).strip(), "Please read this plain sentence before you go on."
    page = f"<body><nav>Menu</nav><article><h1>T</h1><p>{long}</p>{{}}<p>end</p></article><footer>f</footer></body>"
    want = f"T\n\n{long}\n\nend"
    names = ("notice", "site-notice", "replies", "reply", "discussion", "banner", "overlay", "related", "copyright", "legal", "search", "post-comments", "article-ad")
    for name in [f"class={n}" for n in names] + ["id=consent", "id=login", "id=comments", "role=alert"]:
        assert html_text.main_text(page.format(f"<div {name}>{sentence}</div>")) == want, name
        assert html_text.main_text(page.format(f"<div {name}><p>{sentence}</p></div>")) == want, name
    assert html_text.main_text(page.format(f"<p class=legal>{sentence}</p>")) == want
    more = ("more " * 150).strip()
    for box in (f"<div class=legal><p>{more}</p></div>", f"<section id=discussion><p>{more}</p></section>", f"<h2 id=login>{more}</h2>", f"<h2 class=legal>{more}</h2>", f"<p id=notice>{more}</p>", f"<p>{more[:-4]}<span class=notice>more</span></p>"):
        assert html_text.main_text(page.format(box)) == f"T\n\n{long}\n\n{more}\n\nend", box


def test_main_text_keeps_title_lead_and_sibling_articles():
    long, linked = ("word " * 300).strip(), "<p><a href=x>Home</a></p>"
    text = html_text.main_text
    assert text(f"<main>{linked}<h1>Head</h1><p>lead</p><article><p>{long}</p></article></main>") == f"Head\n\nlead\n\n{long}"
    assert text(f"<main>{linked}<article><h1>Head</h1><p>{long}</p></article><p>Another site text</p></main>") == f"Head\n\n{long}"
    header = "<header><nav>n</nav><div><h1>Title <a href=x>one</a></h1></div><p>By nobody</p></header>"
    assert text(f"<body><header><h1>Site</h1></header><article>{header}<p>{long}</p></article></body>") == f"Title one\n\n{long}"
    assert text(f"<main>{header}<p>{long}</p></main>") == f"Title one\n\n{long}"
    assert text(f"<body><article><p>{long}</p></article><article><p>rest</p></article><article>{linked}</article></body>") == f"{long}\n\nrest"
    said = "".join(f"<li><article class=comment-body><p>{long}</p></article>" for _ in range(3))
    for box in (f"<div id=comments><ol class=comment-list>{said}</ol></div>", f"<ol>{said}</ol>"):
        assert text(f"<body><div><article><h1>T</h1><p>{long}</p></article>{box}</div></body>") == f"T\n\n{long}", box
        assert text(f"<body><article><h1>T</h1><p>{long}</p>{box}</article></body>") == f"T\n\n{long}", box
    assert text(f"<body class=has-comments><div class=comments-open><article><p>{long}</p></article></div></body>") == long
    began = time.process_time()
    assert text("<main>t<article>" + "<div><a href=x>y</a>" * 20_000).startswith("t\n\ny")
    assert time.process_time() - began < 10


def test_extract_keeps_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a&amp;b", "t", 5), (2, None, None, "t", 5), (1, "u", "<p>a&amp;b", "t", 5), (None, "v", "", None, None)], "page_id long, url string, html string, text string, n_chars int")
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in html_text.extract(pages).collect())
    assert got == [("1", "a&b", 3), ("1", "a&b", 3), ("2", "", 0), ("None", "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "\\</s>", "ends with \\", "<<SYS>>\n<s>user\n\\\\[INST]", "", None, " ", "<<s>x</s>\n"]
    rows = [(1, i, r, t, "x") for i, (r, t) in enumerate(zip(["system", "user", "assistant", "user", "assistant", "assistant", None, "user"], odd, strict=True))]
    rows += [(2, 0, "user", "alone", "x"), (3, 1, "assistant", "b" * 20_000, "x"), (3, 1, "assistant", "b" * 20_000, "x"), (3, None, "too\nl", "é", "x"), (None, 0, "assistant", "n", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, formatted string")
    made = chat.examples(table)
    got = {r.conv_id: r for r in chat.digest(made).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv in (1, 2, 3, None):
        turns = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3]) for r in rows if r[0] == conv), key=lambda x: (x[0], x[1], x[2] is not None, x[2] or ""))
        loss = "".join(t or "" for _, r, t in turns if r == "assistant")
        want = (len(turns), sha("".join(f"{r}\n{t or ''}\n" for _, r, t in turns)), len(loss), sha(loss))
        assert (got[conv].n_turns, got[conv].turns_sha256, got[conv].loss_chars, got[conv].loss_sha256) == want, conv
    each = sorted((r.example, r.formatted, r.loss_start, r.loss_length) for r in made.where("conv_id = 1").collect())
    assert len(each) == 4 and each[-1][3] == 0  # three replies, and the turns after the last
    for (_, a, _, _), (_, b, start, _) in zip(each[:-1], each[1:], strict=True):
        assert b.startswith(a) and (start is None or start >= len(a))
    assert chat.digest(chat.examples(table.limit(0))).count() == 0


def plain_hits(docs, items, length):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - length + 1)) if w else []:
            windows.setdefault(tuple(w[s : s + length]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if (key := tuple(w[s : s + n])) in windows:
                    hit |= set(range(s, s + n))
                    found |= {str(i) for i in windows[key] if i is not None}
        out.append((str(d), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def test_contamination(spark):
    docs, all_texts = documents(spark), texts()
    items = [(1, all_texts[7]), (10, "ONE"), (2, " ".join(all_texts[13].split()[4000:4012])), (3, None), (4, "..."), (None, all_texts[11]), (5, all_texts[11]), (5, all_texts[11]), (6, "x " * 15), (7, "not in any text at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in phrases.contamination(docs, bench).collect())
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got == plain_hits(rows, items, 10)
    clean = phrases.decontaminate(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not r[5] for r in got)
    assert phrases.contamination(docs, bench.limit(0)).where("contaminated").isEmpty()
    assert phrases.contamination(empty(spark), bench).count() == 0


@pytest.mark.parametrize("most", [phrases.SMALL, 0])
def test_proximity(spark, monkeypatch, most):
    monkeypatch.setattr(phrases, "SMALL", most)
    docs = spark.createDataFrame([(1, "a bb ccc x dddd"), (2, "a bb ccc dddd"), (3, "a x y z bb q r s ccc dddd")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a bb ccc dddd")], "item_id long, text string")
    near = lambda slop: sorted(r["_d"] for r in phrases.occurrences(docs, bench, 10, slop)[0].select("_d").distinct().collect())
    assert near(0) == [2] and near(1) == [1, 2]


def test_rollup_is_idempotent(spark):
    docs = documents(spark)
    paths = {v: public_tokenizers.path(f"{v}.tiktoken") for v in ("byte_bpe_50k", "byte_bpe_multi_50k")}
    counts = token_counts.count_tokens(docs, paths, keep=("doc_id",)).cache()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    want = sorted((str(r.doc_id), len(plain.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert sorted((str(r.doc_id), r.tokens) for r in counts.where("tokenizer_version = 'byte_bpe_50k'").collect()) == want
    import uuid

    rollup = token_counts.Rollup(spark, f"{checkpoint_dir(spark)}/larder-test-{uuid.uuid4().hex}")
    assert rollup.totals().count() == 0
    assert rollup.commit("a", token_counts.inserts(counts)) and not rollup.commit("a", token_counts.inserts(counts))
    total = lambda: {(r.source, r.lang, r.tokenizer_version): (r.docs, r.tokens) for r in rollup.totals().collect()}
    direct = {(r.source, r.lang, r.tokenizer_version): (r.n, r.t) for r in counts.groupBy("source", "lang", "tokenizer_version").agg({"*": "count", "tokens": "sum"}).toDF("source", "lang", "tokenizer_version", "n", "t").collect()}
    assert total() == direct
    rollup.commit("b", token_counts.revisions(counts.selectExpr("*", "tokens * 2 as new_tokens")))
    assert total() == {k: (n, 2 * t) for k, (n, t) in direct.items()}
    rollup.commit("c", token_counts.deletes(counts.where("source = 's0'").withColumn("tokens", counts["tokens"] * 2)))
    assert total() == {k: (n, 2 * t) for k, (n, t) in direct.items() if k[0] != "s0"}
    rollup.commit("none", token_counts.inserts(counts.limit(0)))
    assert rollup.batches() == ["a", "b", "c", "none"]
    with pytest.raises(ValueError):
        rollup.commit("../x", token_counts.inserts(counts))
    # another writer takes the next version first: its batch stays, and this one is added to its totals
    before, race = total(), token_counts.Rollup(spark, rollup.folder)
    publish, turns = race._publish, []

    def late(number, table):
        if not turns:
            turns.append(number)
            rollup.commit("theirs", token_counts.inserts(counts))
        return publish(number, table)

    race._publish = late
    assert race.commit("ours", token_counts.inserts(counts)) and rollup.batches() == ["a", "b", "c", "none", "ours", "theirs"]
    assert total() == {k: (before.get(k, (0, 0))[0] + 2 * n, before.get(k, (0, 0))[1] + 2 * t) for k, (n, t) in direct.items()}
    assert not race.commit("theirs", token_counts.inserts(counts))
    race._publish = lambda number, table: 1 / 0  # a writer that breaks off changes nothing
    now = total()
    with pytest.raises(ZeroDivisionError):
        race.commit("broken", token_counts.inserts(counts))
    assert total() == now and rollup.commit("broken", token_counts.inserts(counts)) and total() != now
    with pytest.raises(ValueError):
        token_counts.count_tokens(docs.withColumn("tokens", docs["doc_id"]), paths, keep=("tokens",))


def test_token_counts_query_equals_a_plain_count(spark, tmp_path):
    import base64

    import regex

    from larder.llm import queries

    def plain_count(text, ranks):
        """Merge the pair of lowest rank, the leftmost first, until none is left."""
        n = 0
        for word in regex.findall(public_tokenizers.PATTERN, text):
            parts = [bytes([b]) for b in word.encode()]
            while len(parts) > 1:
                rank, i = min((ranks.get(a + b, float("inf")), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank == float("inf"):
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            n += len(parts)
        return n

    docs = documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows, want = docs.collect(), {}
    first = {}
    for r in rows:
        if r.text is not None and r.doc_id is not None:
            first[r.text] = min(r.doc_id, first.get(r.text, r.doc_id))
    for version, more in (("byte_bpe_50k", 1), ("byte_bpe_multi_50k", 0)):
        with open(public_tokenizers.path(f"{version}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        for r in rows:
            if r.doc_id is not None and r.text is not None and r.doc_id != first[r.text]:
                continue  # a copy
            n, t = want.get((r.source, r.lang, version), (0, 0))
            want[r.source, r.lang, version] = n + 1, t + plain_count(r.text or "", ranks) + more
    got = {(r.source, r.lang, r.tokenizer_version): (r.docs, r.tokens) for r in queries.op2(spark, str(tmp_path)).collect()}
    assert got == want
    empty(spark).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.op2(spark, f"{tmp_path}/none").count() == 0
