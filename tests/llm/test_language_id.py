import random

from pyspark.sql import functions as F

from eventpipe.llm import language_id
from eventpipe.llm.language_id import host_of, identify, markup_language, parent_of, suffix_of, trigram_slots

KIND = "key bigint, text string, declared string, suffix string, host string"
WORDS = {
    "en": "the and with that thing river shall when under".split(),
    "de": "der und mit das ding fluss wird wenn unter".split(),
}


def sentence(language, r, n=40):
    return " ".join(r.choice(WORDS[language]) for _ in range(n))


def rows(n=200, wrong=0.1):
    r = random.Random(6)
    out = []
    for i in range(n):
        language = "en" if i % 2 else "de"
        declared = language if r.random() > wrong else ("de" if language == "en" else "en")
        out.append((i, sentence(language, r), declared, "uk" if language == "en" else "de", f"h{i % 4}.site.{language}"))
    return out


def run(spark, given):
    return {r.key: r for r in identify(spark.createDataFrame(given, KIND)).collect()}


def test_the_text_outweighs_a_wrong_declaration(spark):
    got = run(spark, rows())
    right = sum(got[i].language == ("en" if i % 2 else "de") for i in range(200))
    assert right >= 198 and all(r.kept for r in got.values())


def test_other_evidence_decides_where_the_text_says_little(spark):
    short = [(1000, "xq", None, "uk", "h1.site.en"), (1001, "xq", None, "de", "h0.site.de"), (1002, "xq", "de", None, None)]
    got = run(spark, rows() + short)
    assert [got[i].language for i in (1000, 1001, 1002)] == ["en", "de", "de"]


def test_texts_without_letters_are_rejected(spark):
    got = run(spark, rows() + [(500, "12 *** $$$", "en", None, None), (501, None, "en", None, None), (502, "", None, None, None)])
    assert [got[i].kept for i in (500, 501, 502)] == [False] * 3
    assert got[500].language == "en"


def test_repeated_rows_nulls_and_long_texts(spark):
    given = rows(20) + [(None, "the and", None, None, None), (3, "the and", "", None, None), (3, "the and", "", None, None)]
    given += [(77, "the river " * 100_000, "en", None, None)]
    assert identify(spark.createDataFrame(given, KIND)).count() == len(given)


def test_no_declared_language_and_empty_table(spark):
    got = run(spark, [(1, "the and", None, None, None)])
    assert got[1].language is None and got[1].kept
    got = run(spark, [(1, "the and", "English", None, None), (2, "12", None, None, None)])
    assert got[1].language is None and got[1].kept and not got[2].kept
    assert run(spark, []) == {}


def test_clashing_extra_columns(spark):
    frame = spark.createDataFrame([(*row, 1, 2) for row in rows(20)], KIND + ", rows int, q int")
    assert identify(frame).columns == ["key", "language", "probability", "kept"]


def test_evidence_from_pages(spark):
    urls = ["https://u@Blog.Example.com:80/x", "//a.b.co/de", "nothing", None, "http://10.0.0.1/", "http://localhost/"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    host = host_of(F.col("url"))
    got = [tuple(r) for r in frame.select(host, suffix_of(host), parent_of(host)).collect()]
    assert got == [
        ("blog.example.com", "com", "example.com"), ("a.b.co", "co", "b.co"), (None, None, ""), (None, None, ""),
        ("10.0.0.1", None, "0.1"), ("localhost", None, ""),
    ]
    pages = ['<!DOCTYPE html><HTML class=x lang="fr-CA">', "<html>", "<html lang=de>", None]
    frame = spark.createDataFrame([(p,) for p in pages], "html string")
    assert [r[0] for r in frame.select(markup_language(F.col("html"))).collect()] == ["fr", None, "de", None]


def test_slots_fold_case_and_signs():
    assert (trigram_slots(b"Ab  c!!d") == trigram_slots(b"ab c d")).all()
    assert not len(trigram_slots(b"ab"))


def many_languages(n):
    """Rows of ``n`` languages, two to a host; the k-th is declared by fewer rows than those before it."""
    r = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [["".join(r.choice(letters) for _ in range(6)) for _ in range(8)] for _ in range(n)]
    of = [k for k in range(n) for _ in range(4 + (n - k) // 20)]
    return [(i, " ".join(r.choice(words[k]) for _ in range(40)), f"{letters[k // 26]}{letters[k % 26]}", None, f"h{k // 2}.site") for i, k in enumerate(of)]


def test_every_declared_language_is_an_answer(spark):
    given = many_languages(70)
    got = run(spark, given)
    assert [(got[i].language, got[i].kept) for i, *_ in given] == [(declared, True) for _, _, declared, *_ in given]


def test_blocks_of_languages_make_no_difference(spark, monkeypatch):
    given = many_languages(6)
    once = run(spark, given)
    for name, value in (("BLOCK_ENTRIES", 150), ("BATCH_ENTRIES", 7), ("WIDTH", 4)):
        monkeypatch.setattr(language_id, name, value)
    blocks = run(spark, given)
    assert all(blocks[i].language == r.language and abs(blocks[i].probability - r.probability) < 1e-9 for i, r in once.items())


FOREIGN = {
    "Finnish": "minä olen täällä tänään koska sataa lunta ja tuuli puhaltaa kovasti metsän yli järvelle",
    "Chinese": "今天天气很好我们一起去公园散步然后回家吃饭看书休息明天继续工作学习",
    "junk": "xqz wvkj qqpz zzxk jvwq kxzj pqwv zkqx vvjq xzkw qjzp wkxv",
    "keys": "fj29dk2 k2j3h4k 9dk2jd8 kd93jf0 2kd9fj3 d9k2j4h f0k3jd9 k3j4d8f",
}


def test_foreign_and_junk_texts_are_rejected_and_clean_ones_kept(spark):
    given = rows(400)
    strange = [(1000 + i, text, None, "uk", "h1.site.en") for i, text in enumerate(FOREIGN.values())]
    got = run(spark, given + strange)
    assert all(got[i].kept for i, *_ in given)
    assert [(got[i].language, got[i].kept) for i, *_ in strange] == [(None, False)] * len(strange)


def test_regions_are_codes_and_other_names_no_declaration(spark):
    given = [(i, text, {"en": "EN-us", "de": " de_CH"}.get(declared, declared), None, None) for i, text, declared, *_ in rows(100, 0.0)]
    got = run(spark, given + [(500, "the and with that", "english language", None, None)])
    assert {r.language for r in got.values()} == {"en", "de"} and got[500].language == "en"


def test_a_rare_language_and_a_group_of_copies(spark):
    """The common language has a hundred times the rows, and a third of them are one text."""
    r = random.Random(3)
    common = [(i, sentence("en", r) if i % 3 else "the river and that thing under the river", "en", None, None) for i in range(3000)]
    rare = [(10_000 + i, sentence("de", r), "de", None, None) for i in range(30)]
    got = run(spark, common + rare)
    assert all(got[i].language == "de" for i, *_ in rare) and all(got[i].language == "en" for i, *_ in common)


def test_five_hundred_languages(spark):
    given = many_languages(500)
    got = run(spark, given)
    right = sum(got[i].language == declared for i, _, declared, *_ in given)
    assert right >= 0.999 * len(given)
