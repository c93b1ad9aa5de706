
import pytest
from pyspark.sql import functions as F

from lingmill.functions import messages, templates, text

SPACES = "".join(chr(i) for i in range(0x3100) if chr(i).isspace())


def values(spark, items, column):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string")
    return [r.y for r in rows.select("i", column.alias("y")).orderBy("i").collect()]


def test_strip_equals_python(spark):
    items = [SPACES + "a b" + SPACES, SPACES, "", "x", "\x1cé\x85", None, "​kept​"]
    got = values(spark, items, text.strip(F.col("x")))
    assert got == [None if x is None else x.strip() for x in items]


def expected_items(source):
    out = []
    for i, line in enumerate(source.split("\n")):
        number = str(i + 1)
        if line[: len(number)] == number:
            item = line[len(number):].strip(" .-。")
            if item.strip():
                out.append(item)
    return out


@pytest.mark.parametrize(
    "source",
    [
        "1. one\n2. two\n3- three。",
        "Here you are:\n1. one\n2. two",
        "\n1. one\n2. two",
        "10 things\n2. two",
        "1.\n2. 　\n3. x",
        "1. a\n\n2. b\n4. d",
        "",
        "\n".join(f"{i}. item {i}" for i in range(1, 125)),
    ],
)
def test_numbered_items_by_absolute_line(spark, source):
    assert values(spark, [source], text.numbered_items(F.col("x"))) == [expected_items(source)]


def test_render_then_parse(spark):
    items = [f"say {i} things" for i in range(1, 31)]
    df = spark.createDataFrame([(items,)], "a array<string>")
    back = text.numbered_items(text.render_numbered(F.col("a")))
    assert df.select(back.alias("b")).first().b == items


@pytest.mark.parametrize(
    "reply, prompt, response",
    [
        ("<<PROMPT>>\np\n<<RESPONSE>>\nr", "p", "r"),
        ("x <<PROMPT>>p<<RESPONSE>>r1<<RESPONSE>>r2", "p<<RESPONSE>>r1", "r2"),
        ("<<PROMPT>>p<<RESPONSE>>r<<RESPONSE>>", "p", "r<<RESPONSE>>"),
        ("<<PROMPT>><<RESPONSE>>r", None, None),
        ("<<PROMPT>> \n <<RESPONSE>>r", "", "r"),
        ("<<RESPONSE>>r<<PROMPT>>p", None, None),
        ("<<PROMPT>>a<<PROMPT>>b<<RESPONSE>>c", "a<<PROMPT>>b", "c"),
        ("nothing", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_marked_reply(spark, reply, prompt, response):
    df = spark.createDataFrame([(reply,)], "x string")
    got = df.select(text.marked_prompt(F.col("x")).alias("p"), text.marked_response(F.col("x")).alias("r")).first()
    assert (got.p, got.r) == (prompt, response)


def test_id_parts(spark):
    ids = ["en_12_0", "a_b_c_10", "plain", "_x", "x_"]
    assert values(spark, ids, text.id_stem(F.col("x"))) == ["en_12", "a_b_c", "", "", "x"]
    assert values(spark, ids, text.id_tail(F.col("x"))) == ["0", "10", "plain", "x", ""]


def test_zero_padding_keeps_long_numbers(spark):
    df = spark.createDataFrame([(7,), (1234567,)], "n long")
    assert [r.z for r in df.select(text.zero_padded(F.col("n"), 6).alias("z")).collect()] == ["000007", "1234567"]


def test_blocklist_is_a_plain_substring(spark):
    items = ["My username", "ok", "NAME", "a chatGPTish thing", "nam e"]
    got = values(spark, items, text.contains_any(F.col("x"), ["name", "gpt"]))
    assert got == [True, False, True, True, False]


def test_revision_budget(spark):
    df = spark.createDataFrame([(10, 20), (3000, 1), (0, 0)], "a int, b int")
    got = [r.m for r in df.select(text.revision_budget(F.col("a"), F.col("b")).alias("m")).collect()]
    assert got == [60, 4095, 0]


def test_letters_and_truncation(spark):
    df = spark.createDataFrame([("a b  c\nd",)], "x string")
    row = df.select(
        text.letter(F.lit(0)).alias("a"), text.letter(F.lit(25)).alias("z"),
        text.truncate_words(F.col("x"), 3).alias("cut"), text.truncate_words(F.col("x"), 4).alias("whole"),
    ).first()
    assert row.asDict() == {"a": "A", "z": "Z", "cut": "a b c", "whole": "a b  c\nd"}


def test_template_slots_and_braces(spark):
    df = spark.createDataFrame([("Thai",)], "l string")
    made = templates.fill("in {l}: {{x}} {l}", {"l": F.col("l")})
    assert df.select(made.alias("m")).first().m == "in Thai: {x} Thai"
    for name in ("score_pair", "article_pair", "rank_responses"):
        assert name in templates.DEFAULT_TEMPLATES


def test_moderation_reads_the_first_record(spark):
    rows = [
        (1, [({"a": False, "b": True},)]),
        (2, [({"a": False},), ({"a": True},)]),
        (3, [({"a": None},)]),
        (4, []),
        (5, None),
    ]
    df = spark.createDataFrame(rows, "i int, m array<struct<categories:map<string,boolean>>>")
    got = {r.i: r.f for r in df.select("i", messages.flagged(F.col("m")).alias("f")).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_put_answer_never_replaces_a_good_one(spark):
    schema = "i int, m map<string,struct<content:string,finish_reason:string>>"
    rows = [
        (1, {"a": ("good", "stop"), "b": ("other", "stop")}),
        (2, {"a": (None, None), "b": ("other", "stop")}),
        (3, None),
        (4, {"b": ("other", "stop")}),
    ]
    df = spark.createDataFrame(rows, schema)
    out = df.select("i", messages.put_answer(F.col("m"), "a", F.lit("new"), F.lit("stop")).alias("m"))
    got = {r.i: {k: v.content for k, v in r.m.items()} for r in out.collect()}
    assert got == {
        1: {"a": "good", "b": "other"},
        2: {"a": "new", "b": "other"},
        3: {"a": "new"},
        4: {"a": "new", "b": "other"},
    }
