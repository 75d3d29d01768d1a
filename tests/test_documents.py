import json

import pytest
from pyspark.sql import functions as F

from winnow.functions import replies as R
from winnow.operators.documents import (
    application_payload,
    build_prompts,
    folder_collisions,
    parse_responses,
    prompt_errors,
    render_documents,
    response_errors,
)
from winnow.operators.state import mark_generated
from winnow.operators.vocabulary import role_rules
from winnow.sources.templates import render

IDENTITY = {
    "first_name": "Ivo", "last_name": "Test", "location": "Oslo_1", "phone": "0", "email": "i@x", "linkedin": "ivo",
}


# Reply keys are fixed values.
USABLE = [
    'x {"cover_letter_body":["a ","b"]} tail',
    '{"cover_letter_body":{"paragraphs":["p1"," p2"]}}',
    '{"cover_letter_body":" s "}',
    '{"cover_letter_body":7}',
    '{"cover_letter_body":{"x":1}}',
    '{"cover_letter_body":{"paragraphs":"p"}}',
    '{"cover_letter_body":null}',
    '{"cover_letter_body":[]}',
    '{"k":1}',
    '{"a":[{"x":1}]}',
    '{"a":{"b":[1,{"c":2}\n]}}',
    '[{"a":1}]',
    '{"a":"}] {"}',
    '{"a":"\\u00e9 \\" \\\\"}',
]
UNUSABLE = [
    "{}", "{ \n}", "none", "{bad}", "", "}{", "}", "{", "{'a':1}",
    '{"a":1} and {"b":2}',
    '{"a":1}, {"b":2}',
    '{"a":1}, null, {"b":2}',
    '{"a":1}] x [{"b":1}',
    '{"a":[{"x":1}]}} {"b":1}',
    '{"a":"x\ny"}',
    '{"a":01}',
    '{"a":1,}',
]


def test_reply_object(evaluate):
    usable = R.reply_object(F.col("raw")).isNotNull()
    assert all(evaluate([(r,) for r in USABLE], "raw string", usable))
    assert not any(evaluate([(r,) for r in UNUSABLE], "raw string", usable))
    assert evaluate([(None,)], "raw string", R.reply_object(F.col("raw")).isNull()) == [True]


def test_cover_body(evaluate):
    body = R.cover_body(F.try_variant_get(R.reply_object(F.col("raw")), "$.cover_letter_body", "variant"))
    got = evaluate([(r,) for r in USABLE[:9]], "raw string", body)
    assert got == ["a\n\nb", "p1\n\np2", "s", "", "", "", "", "", ""]
    mixed = '{"cover_letter_body":[" a", 1, 1.5, ["x"], "b\\u00a0"]}'
    assert evaluate([(mixed,)], "raw string", body) == ['a\n\n1\n\n1.5\n\n["x"]\n\nb']


def test_bullets(evaluate):
    bullets = R.bullets(F.try_variant_get(R.reply_object(F.col("raw")), "$.b", "variant"))
    raws = ['{"b":[" a_", 1, null, "50%"]}', '{"b":" one_ "}', '{"b":7}', '{"c":1}', '{"b":[]}']
    got = evaluate([(r,) for r in raws], "raw string", bullets)
    assert got == [[" a\\_", "", "", "50\\%"], ["one\\_"], [], [], []]


JOB = "id string, company string, title string, location string, description string, status string"


@pytest.fixture
def jobs(spark):
    return spark.createDataFrame(
        [
            ("1", "A&B", "FX TD (Paris)", "Paris", "d" * 3000, "approved"),
            ("2", "A&B", "FX TD (Paris)", "Oslo", "x\ny", "approved"),
            ("3", "C", "TD", "Oslo", None, "approved"),
            ("4", "C", "TD", "Oslo", "x", "scraped"),
            ("5", "C", None, "Oslo", "x", "approved"),
        ],
        JOB,
    )


@pytest.fixture
def responses(spark):
    reply = {
        "job_title_target": " TD_1 ", "profile_summary": "50%", "experience_bullets": ["a&b", 3],
        "cover_letter_body": ["x_1 ", "y"], "first_name": "Other", "h_profile": "Other",
    }
    return spark.createDataFrame(
        [("1", "Sure! " + json.dumps(reply)), ("2", json.dumps({"profile_summary": 5})), ("3", json.dumps(reply)),
         ("4", json.dumps(reply)), ("5", "{bad}"), ("9", json.dumps(reply))],
        "id string, raw string",
    )


def test_prompts(jobs):
    rows = {r.id: r for r in build_prompts(jobs, "ME").collect()}
    assert set(rows) == {"1", "2", "5"}
    want = (  # fixed value: the wording of the prompt
        "\nYou are a professional recruiter and ATS resume writer.\n\nLANGUAGE: FRENCH\n\nJOB DESCRIPTION:\n"
        + "d" * 2500
        + "\n\nCANDIDATE PROFILE:\nME\n\nRETURN PURE JSON ONLY:\n{\n"
        + '  "job_title_target": "FX TD (Paris)",\n  "profile_summary": "2 sentences, first person",\n'
        + '  "experience_bullets": ["...", "...", "...", "..."],\n'
        + '  "cover_letter_body": "3 paragraphs separated by double newlines"\n}\n'
    )
    assert rows["1"].prompt == want and rows["1"].lang == "FR"
    assert "LANGUAGE: ENGLISH" in rows["2"].prompt and rows["2"].lang == "EN"
    assert '"job_title_target": "None"' in rows["5"].prompt
    assert [tuple(r) for r in prompt_errors(jobs).collect()] == [("3", "prompt", "no description")]


def test_payload_and_documents(jobs, responses):
    payload = application_payload(jobs, responses, IDENTITY, skills={"A": "b_c"})
    rows = {r.id: r for r in payload.collect()}
    assert set(rows) == {"1", "2"}
    one, two = rows["1"], rows["2"]
    assert (one.lang, one.folder, one.company_name) == ("FR", "A_B_FX_TD_Paris_", "A\\&B")
    assert (one.job_title_target, one.profile_summary) == ("TD\\_1", "50\\%")
    assert (one.experience_bullets, one.cover_letter_body) == (["a\\&b", ""], "x\\_1\n\ny")
    assert (one.identity.first_name, one.identity.location) == ("Ivo", "Oslo\\_1")
    assert one.labels["h_profile"] == "Profil" and two.labels["h_profile"] == "Profile"
    assert one.skills == {"A": "b_c"}
    assert (two.job_title_target, two.profile_summary, two.experience_bullets, two.cover_letter_body) == ("", "5", [], "")

    templates = {"resume": "<< first_name >> <<h_profile>>:<% for b in experience_bullets %>-<< b >>;<% endfor %>", "cover": "<< cover_letter_body >>\n"}
    docs = {(r.id, r.kind): r.body for r in render_documents(payload, templates).collect()}
    assert docs == {("1", "resume"): "Ivo Profil:-a\\&b;-;", ("2", "resume"): "Ivo Profile:", ("1", "cover"): "x\\_1\n\ny", ("2", "cover"): ""}
    assert [tuple(r) for r in folder_collisions(payload).collect()] == [("A_B_FX_TD_Paris_", 2, "1")]
    apart = {r.folder for r in render_documents(payload, templates, id_suffix=True).collect()}
    assert apart == {"A_B_FX_TD_Paris__1", "A_B_FX_TD_Paris__2"}
    status = {r.id: r.status for r in mark_generated(jobs, payload).collect()}
    assert status == {"1": "generated", "2": "generated", "3": "approved", "4": "scraped", "5": "approved"}
    errors = {r.id for r in response_errors(responses).collect()}
    assert errors == {"5"} and parse_responses(responses).count() == 6


def test_labels_win_and_one_reply_counts(spark, jobs, responses):
    older = spark.createDataFrame([("1", '{"profile_summary":"zz"}'), ("1", "{bad}")], "id string, raw string")
    payload = application_payload(jobs, responses.union(older), {**IDENTITY, "h_profile": "MINE"})
    docs = {r.id: r.body for r in render_documents(payload, {"cv": "<< h_profile >> << profile_summary >>"}).collect()}
    assert docs == {"1": "Profil zz", "2": "Profile 5"} and payload.count() == 2


def test_empty_lists_match_nothing(spark):
    rows = spark.createDataFrame([("FX TD",), (None,)], "title string")
    found = role_rules(rows, "title", include=[], soft_exclude=[]).collect()
    assert not any(r.role_included or r.role_soft_excluded for r in found)


def test_replies_are_parsed_once(jobs, responses):
    plan = application_payload(jobs, responses, IDENTITY)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?s)") == 1


def test_templates(evaluate):
    values = {"a": F.col("a"), "xs": F.split("a", ""), "m": F.create_map(F.lit("k"), F.col("a"))}
    cases = {
        "1<< a >>2<<nope>>3\n": "1xy23",
        "<# no #>z\n\n": "z\n",
        "<% for x in xs %>[<< x >><< a >>]<% endfor %>.": "[xxy][yxy].",
        "<% for k, v in m.items() %><< k >>=<< v >><% endfor %>": "k=xy",
        "<% for x in xs %><% for y in xs %><< x >><< y >> <% endfor %>|<% endfor %>": "xx xy |yx yy |",
        "<% for x in nope %>gone<% endfor %>": "",
        "\\x{<< a >>} % plain": "\\x{xy} % plain",
    }
    for template, want in cases.items():
        assert evaluate([("xy",)], "a string", render(template, values)) == [want]
    with pytest.raises(ValueError):
        render("<% if a %>", values)
    with pytest.raises(ValueError):
        render("<% for x in xs %>", values)
