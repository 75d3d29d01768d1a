import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from winnow import defaults
from winnow.functions import text as X
from winnow.functions import urls as U
from winnow.operators.documents import country_of
from winnow.operators.vocabulary import role_rules, skill_tags

URL, NAME = F.col("a"), F.col("b")


def one(evaluate, values, expr):
    return evaluate([(v,) for v in values], "a string", expr)


def test_company_name(evaluate):
    cases = {
        "https://career.paradoxplaza.com/jobs": "paradoxplaza",
        "https://www.ilpvfx.com/jobs/": "ilp",
        "https://fablefx.com/jobs/": "fablefx",
        "https://dont-nod.com/en/careers/": "dont-nod",
        "https://apply.workable.com/one-of-us/": "apply",
        "https://careers.smartrecruiters.com/RodeoFX": "smartrecruiters",
        "http://localhost:8080/x": "localhost:8080/x",
        "https://jobs": "unknown",
        "nourl": "unknown",
        None: "unknown",
    }
    assert one(evaluate, cases, U.company_name(URL)) == list(cases.values())


def test_detect_ats(evaluate):
    cases = {
        "https://CLEVER.com/x": ("lever", "Lever"),
        "https://boards.greenhouse.io/a": ("greenhouse", "Greenhouse"),
        "https://jobs.ashbyhq.com/a": ("ashby", "Ashby"),
        "https://x.myworkdayjobs.com/a": ("workday", "Workday"),
        "https://a.b/?u=teamtailor.com": ("simple", "Simple/HTML"),
        "//user@x.teamtailor.com:80/": ("teamtailor", "Teamtailor"),
        "nourl": ("simple", "Simple/HTML"),
        None: ("simple", "Simple/HTML"),
    }
    got = one(evaluate, cases, U.detect_ats(URL))
    assert [tuple(r) for r in got] == list(cases.values())


def test_normalize_url(evaluate):
    cases = [
        ("https://a.b/c", "x", "https://a.b/c"),
        ("//a.b/c", "x", "https://a.b/c"),
        ("/x/1", "https://h/jobs/", "https://h/jobs/x/1"),
        ("x", "https://h//", "https://h/x"),
        ("/x", "https://h/j?p=1", "https://h/j?p=1/x"),
        ("#top", "https://h", "https://h/#top"),
        ("HTTP://a/b", "https://h", "https://h/HTTP://a/b"),
        ("httpfoo", "https://h", "httpfoo"),
        ("///x", "https://h", "https:///x"),
    ]
    got = evaluate([c[:2] for c in cases], "a string, b string", U.normalize_url(URL, NAME))
    assert got == [c[2] for c in cases]
    again = evaluate([(g, "https://z") for g in got], "a string, b string", U.normalize_url(URL, NAME))
    assert again == got


def test_other_urls(evaluate):
    fixed = {"/jobs/1": "https:/jobs/1", "//h/jobs/1": "https://h/jobs/1", "https://h/jobs/1": "https://h/jobs/1"}
    assert one(evaluate, fixed, U.scheme_fixed_url(URL)) == list(fixed.values())
    site = [("/x", "https://h/jobs/", "https://h/x"), ("x", "https://h/jobs/", "https://h/jobs/x"), ("http://y", "z", "http://y")]
    got = evaluate([c[:2] for c in site], "a string, b string", U.site_url(URL, NAME))
    assert got == [c[2] for c in site]


def test_role(evaluate):
    cases = {"FX TD": True, "Acme Ltd sales": True, "International Tax": True, "Head of X": True, "Office Manager": False, "": False, None: False}
    assert one(evaluate, cases, X.matches_role(URL, defaults.ROLE_KEYWORDS)) == list(cases.values())
    assert one(evaluate, ["a.c", "abc", "a+c"], X.contains_any(URL, ["a.c", "+"])) == [True, False, True]
    assert one(evaluate, ["a", None], X.contains_any(URL, [])) == [False, False]


def test_tokens(evaluate):
    got = one(evaluate, ["Señor Pipeline TD – C++ x² a_b td", "", None], X.tokenize(URL))
    assert [set(t) for t in got] == [{"señor", "pipeline", "td", "c", "x²", "a_b"}, set(), set()]
    assert len(got[0]) == 6


def test_classify(evaluate):
    cases = {
        "Pipeline TD": ("approved", 2, "Positive match: pipeline, td"),
        "TD td TD": ("approved", 1, "Positive match: td"),
        "Senior Pipeline TD": ("ignored", 0, "Negative match: senior"),
        "Lead FX Artist": ("ignored", 0, "Negative match: fx, lead"),
        "Java Developer": ("approved", 1, "Positive match: developer"),
        "pipeline_td": ("ignored", 0, "No keywords matched"),
        "Mid-level Runner": ("approved", 2, "Positive match: mid, runner"),
        "": ("ignored", 0, "No keywords matched"),
        None: ("ignored", 0, "No keywords matched"),
    }
    got = one(evaluate, cases, X.classify(URL, defaults.POSITIVE_KEYWORDS, defaults.NEGATIVE_KEYWORDS))
    assert [tuple(r) for r in got] == list(cases.values())


def test_names(evaluate):
    cases = {"Senior C++ Developer (Stockholm)": "Senior_C_Developer_Stockholm", None: "Unknown", "": "Unknown", "!!!": "", "a__-b é": "a_-b_é"}
    assert one(evaluate, cases, X.sanitize_filename(URL)) == list(cases.values())
    got = evaluate([("A&B", "FX TD (Paris)"), (None, "x")], "a string, b string", X.output_folder(URL, NAME))
    assert got == ["A_B_FX_TD_Paris_", "None_x"]
    got = evaluate([("A&B", "x")], "a string, b string", X.output_folder(URL, NAME, F.lit("0123456789")))
    assert got == ["A_B_x_012345"]
    raw = X.raw_filename(URL, NAME, F.lit(None).cast("string"), F.md5(F.lit("x")))
    assert evaluate([("Ac me", "TD!")], "a string, b string", raw) == ["Ac_me__TD__Unknown__9dd4e4.html"]


def test_country(evaluate):
    cases = [
        ("Paris", "any", "FR"),
        ("Remote", "a comparison", "FR"),
        ("Stockholm", "offices in Lyon", "FR"),
        ("Gothenburg", None, "SE"),
        ("Malmö", "", "INT"),
        (None, None, "INT"),
    ]
    got = evaluate([c[:2] for c in cases], "a string, b string", country_of(URL, NAME))
    assert got == [c[2] for c in cases]


def test_escape_example(evaluate):
    text = r"a\b {50%} & $1 #2 x_y ~ ^"
    want = r"a\textbackslash{}b \{50\%\} \& \$1 \#2 x\_y \textasciitilde{} \textasciicircum{}"
    assert one(evaluate, [text, None, text + "\x01" + text], X.escape_tex(URL)) == [want, "", want + "\x01" + want]
    assert one(evaluate, [""], X.escaped_lit(f" {text}\n")) == [want]


@settings(max_examples=8, deadline=None, derandomize=True)
@given(st.lists(st.text(alphabet="\\&%$#_{}~^ab\x01é\n", max_size=30), min_size=20, max_size=40))
def test_escape_is_one_pass(evaluate, texts):
    table = str.maketrans(X.TEX)
    assert one(evaluate, texts, X.escape_tex(URL)) == [t.translate(table) for t in texts]


@settings(max_examples=8, deadline=None, derandomize=True)
@given(st.lists(st.text(alphabet="a \t\n\x0b\x1c\x1f\x85\xa0\u1680\u2003\u2029\u202f\u3000\u200bx", max_size=12), min_size=20, max_size=40))
def test_strip(evaluate, texts):
    assert one(evaluate, texts, X.strip(URL)) == [t.strip() for t in texts]


def test_whitespace_is_all_of_it():
    assert set(X.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_tokens_like_python_words(evaluate):
    texts = ["a-b c_d", "naïve café", "x² ½ 3rd", "汉字 test", "π≈3", "Σσ", "don't"]
    got = one(evaluate, texts, X.tokenize(URL))
    assert [set(t) for t in got] == [set(re.findall(r"\b\w+\b", t.lower())) for t in texts]


def test_vocabulary(spark):
    df = spark.createDataFrame(
        [(1, "C++ and unity, python3 Git"), (2, "xC++ CI/CDs"), (3, "ci/cd; c++"), (4, None)], "id int, text string"
    )
    got = {(r.id, r.group): r.skills for r in skill_tags(df, "text").collect()}
    assert got == {
        (1, "engine"): ["C++", "Unity"],
        (1, "general"): ["C++", "Git"],
        (3, "engine"): ["C++"],
        (3, "general"): ["C++", "CI/CD"],
    }
    rows = role_rules(spark.createDataFrame([("lead producer",), ("Cook",), (None,)], "t string"), "t").collect()
    assert [tuple(r)[1:] for r in rows] == [(True, True), (False, False), (False, False)]
