import pytest

from heddle.llm.confusables import _Prototypes, match_display, skeleton, skeleton_groups, unicode_table


@pytest.mark.parametrize("a,b", [("Norvale TV", "Ｎｏｒｖａｌｅ　ＴＶ"), ("Canal Ménora", "Canal Ménora"), ("Copex Action", "Сорех Асtіоn"), ("海台", "海台"), ("鹿山", "⿅⼭"), ("Max-7 A", "Max‑7\u00a0A"), ("abc", "a\u200bb\u00ad\ufeffc\u2060"), ("Ново", "Hoвo"), ("(x)", "（x）"), ("ΝΒΧ", "NBX"), ("Ёж", "Ёж")])
def test_same_look(a, b):
    assert skeleton(a) == skeleton(b)


@pytest.mark.parametrize("a,b", [("Canal Ménora", "Canal Menora"), ("TV", "tv"), ("O2", "02"), ("Il", "ll"), ("TV+", "TV"), ("Max-7", "Max7"), ("Max 7", "Max7"), ("x²", "x2"), ("①", "1"), ("rn", "m")])
def test_other_look(a, b):
    assert skeleton(a) != skeleton(b)


def test_null_empty_invisible_long():
    assert skeleton(None) is None and skeleton("") == "" and skeleton("\u200b\u00ad") == "" and skeleton("\t 　") == ""
    assert skeleton("а" * 100_000) == "a" * 100_000


def test_match(spark):
    vocab = spark.createDataFrame([(1, "Canal Ménora"), (2, "Canal Menora"), (3, None), (4, "\u200b"), (5, "Opal")], "vid int, entry string")
    rows = [(1, "Canal Menоra"), (2, "Canal Menora"), (3, None), (4, ""), (5, "Ｏpal"), (5, "Ｏpal"), (None, "Орal"), (7, "opal")]
    df = spark.createDataFrame([(*r, "f", 9) for r in rows], "id long, name string, form string, entry_id int")
    got = match_display(df, id="id", column="name", vocab=vocab, vocab_id="vid", vocab_column="entry")
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 2), (5, 5), (5, 5), (None, 5)]
    assert match_display(df.limit(0), id="id", column="name", vocab=vocab.limit(0), vocab_id="vid", vocab_column="entry").count() == 0


def test_groups(spark):
    df = spark.createDataFrame([("Opal",), ("Ｏpal",), ("Opal",), (None,), ("",)], "name string")
    assert sorted(map(tuple, skeleton_groups(df, column="name").collect())) == [("", 1, 1, ""), ("Opal", 2, 3, "Opal")]


@pytest.fixture(scope="module")
def table(spark):
    return _Prototypes(unicode_table(spark))


@pytest.mark.parametrize("a,b", [("ı", "i"), ("α", "a"), ("ꓐ", "B"), ("ǃ", "!"), ("ᴄ", "c"), ("ѵ", "v"), ("ꓫ", "X"), ("ⲟ", "o"), ("ℓ", "l"), ("Ⅿ", "M"), ("І", "I"), ("Ｏ", "O"), ("ﬁn", "fin"), ("𝐀", "A"), ("ӏ", "i")])
def test_the_table_of_unicode(table, a, b):
    assert skeleton(a, table) == skeleton(b, table)


@pytest.mark.parametrize("a,b", [("TV", "tv"), ("O2", "02"), ("Il", "ll"), ("rn", "m"), ("Canal Ménora", "Canal Menora"), ("x²", "x2"), ("①", "1"), ("工口", "工囗A"), ("Max-7", "Max7")])
def test_the_table_keeps_apart(table, a, b):
    assert skeleton(a, table) != skeleton(b, table)


def test_look_alikes_within_ascii_if_asked_for(spark):
    t = _Prototypes(unicode_table(spark, ascii_alike=True))
    assert len(t.table) > 10_000
    for a, b in (("I1|l", "llll"), ("O0", "OO"), ("modern", "rnodern"), ("pay1", "payI"), ("аррӏе", "appie")):
        assert skeleton(a, t) == skeleton(b, t)
    assert skeleton("Opal", t) != skeleton("opal", t)
    vocab = spark.createDataFrame([(1, "Il0")], "vid int, entry string")
    df = spark.createDataFrame([(1, "IlO"), (2, "l1o"), (3, "Il0")], "id long, name string")
    run = lambda flag: [tuple(r) for r in match_display(df, id="id", column="name", vocab=vocab, vocab_id="vid", vocab_column="entry", ascii_alike=flag).collect()]
    assert run(True) == [(1, 1)] and run(False) == []
