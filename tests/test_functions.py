from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strandtide.functions import dates, mining, precedence, sequence, text


@pytest.mark.parametrize(
    "raw, iso",
    [
        ("2021-03-04", "2021-03-04"), ("2021", "2021-XX-XX"), ("XX-03-2021", "2021-03-XX"), ("2021-03-04T10:11:12Z", "2021-03-04"), ("XX-XX-2021", "2021-XX-XX"),
        ("XX-XX-XXXX", "XXXX-XX-XX"), ("3.2021", "2021-03-XX"), ("03-2021", "2021-03-XX"), ("4.3.2021", "2021-03-04"), ("Mar-2021", "2021-03-XX"), ("04-mar-2021", "2021-03-04"),
        ("2021-03", "2021-03-XX"), ("30-Feb-2021", "XXXX-XX-XX"), ("29.02.2020", "2020-02-29"), ("13-2021", "XXXX-XX-XX"), ("x", "XXXX-XX-XX"), ("", "XXXX-XX-XX"), (" 2021 ", "2021-XX-XX"),
    ],
)
def test_format_date(one, raw, iso):
    assert one(dates.format_date(F.col("x")), x=raw) == iso
    kept = one(dates.format_date(F.col("x"), mask_failure=False), x=raw)
    assert kept == (raw if iso == dates.UNKNOWN_DATE and raw != "XX-XX-XXXX" else iso)


def test_format_order_decides_and_unknown_directive_fails(one):
    assert one(dates.format_date(F.col("x"), ["%m-%d-%Y", "%d-%m-%Y"]), x="04-03-2021") == "2021-04-03"
    assert one(dates.format_date(F.col("x"), ["%m-%d-%Y", "%d-%m-%Y"]), x="14-03-2021") == "2021-03-14"
    with pytest.raises(ValueError):
        dates.format_date(F.col("x"), ["%j"])


@pytest.mark.parametrize("iso, lo, hi", [("2020-XX-XX", "2020-01-01", "2020-12-31"), ("2020-02-XX", "2020-02-01", "2020-02-29"), ("2020-02-03", "2020-02-03", "2020-02-03"), ("2020", "2020-01-01", "2020-12-31"), ("XXXX-XX-XX", None, None), ("2020-02-31", None, None)])
def test_date_bounds(one, iso, lo, hi):
    got = one(dates.date_bounds(F.col("x")), x=iso)
    assert (str(got["lo"]) if got["lo"] else None, str(got["hi"]) if got["hi"] else None) == (lo, hi)


def test_min_date_uses_the_latest_possible_day(one):
    assert one(dates.on_or_after(F.col("x"), 1975), x="1975-XX-XX")
    assert one(dates.on_or_after(F.col("x"), "1975-06-01"), x="1975-XX-XX")
    assert not one(dates.on_or_after(F.col("x"), 1975), x="1974-12-XX")
    assert not one(dates.on_or_after(F.col("x"), 1975), x="XXXX-XX-XX")


def test_numeric_date_rounds_half_to_even(one):
    assert one(dates.numeric_date(F.lit("2024-02-16").cast("date"))) == 2024.12
    assert one(F.bround(F.lit(2024.125), 2)) == 2024.12


@pytest.mark.parametrize("age, label", [(0.0, "0-3 m/o"), (0.25, "4-6 m/o"), (0.5, "7-12 m/o"), (1.0, "1-5 y/o"), (6.0, "6-10 y/o"), (11.0, "11-17 y/o"), (18.0, "18+ y/o"), (float("nan"), "nan")])
def test_age_range(one, age, label):
    assert one(dates.age_range(F.col("x")), x=age) == label


def test_shared_bound_goes_to_the_first_bin(one):
    assert one(dates.range_label(F.col("x"), [("a", 0, 1), ("b", 1, 5)]), x=1.0) == "a"
    assert one(dates.range_label(F.col("x"), [("a", 0, 1)]), x=7.0) is None


@pytest.mark.parametrize("span, share", [((0, 5), 0.0), ((31, 40), 0.0), ((5, 35), 1.0), ((15, 20), 0.25), ((20, 40), 0.5), ((0, 20), 0.5)])
def test_interval_coverage(one, span, share):
    got = one(dates.interval_coverage(F.lit(10.0), F.lit(30.0), F.lit(float(span[0])), F.lit(float(span[1]))))
    assert got == pytest.approx(share)


@pytest.mark.parametrize("raw, out", [("south-eastern_asia", "South-Eastern_Asia"), ("d'ivoire", "D'Ivoire"), ("ABC def", "Abc Def")])
def test_title_letters(one, raw, out):
    assert one(text.title_letters(F.col("x")), x=raw) == out


@pytest.mark.parametrize("raw, out", [("UK", "United Kingdom"), ("Hongkong", "Hong Kong"), ("usa", "USA"), ("FRANCE", "France"), ("côte d'ivoire", "côte d'ivoire"), ("ivory coast", "Côte D'Ivoire"), ("a_b   c", "a b c"), ("  ", None)])
def test_correct_country(one, raw, out):
    assert one(text.correct_country(F.col("x")), x=raw) == out


def test_parse_location(one):
    assert tuple(one(text.parse_location(F.col("x")), x=" USA: New York, Albany, x ")) == ("USA", "New York", "Albany, x")
    assert tuple(one(text.parse_location(F.col("x")), x="USA")) == ("USA", None, None)
    assert tuple(one(text.parse_location(F.col("x")), x="USA: ")) == ("USA", None, None)


def test_normalize_composes_and_squeezes(spark):
    df = spark.createDataFrame([("  éa  b\t",), ("plain",), (None,)], "x string")
    assert [r["x"] for r in text.normalize_strings(df).collect()] == ["éa b", "plain", None]


def test_split_multi(one):
    assert one(text.split_multi(F.col("x")), x=" a, b or c/d;; e\n") == ["a", "b", "c", "d", "e"]


def test_attributes_keep_the_last_of_a_key(one):
    assert one(text.parse_attributes(F.col("x")), x="a=1;b=2=3;a=4;junk") == {"a": "4", "b": "2=3"}
    assert one(text.safe_feature_name(F.col("x")), x="a b.(c)") == "a_b__c_"


def test_gender_strain_digits(one):
    assert [one(text.parse_gender(F.col("x")), x=v) for v in ("FEMALE", "male", "other")] == ["F", "M", "other"]
    assert one(text.pick_strain(F.lit("ab"), F.lit("abc"))) == "abc"
    assert one(text.pick_strain(F.lit(""), F.lit("i"))) == "i"
    assert one(text.pick_strain(F.lit("abc"), F.lit(None).cast("string"))) == "abc"
    assert one(text.extract_digits(F.col("x"), 3, "last"), x="a1b2c3d4") == "234"
    with pytest.raises(ValueError):
        text.extract_digits(F.col("x"), 3, "middle")


def test_accession_words(one):
    assert one(text.accession_in(F.col("x")), x="strain AB123456 x") == "AB123456"
    assert one(text.accession_in(F.col("x")), x=" sample 1 ") == "sample 1"
    assert not one(text.looks_like_accession(F.col("x")), x="AB1234567")
    assert one(text.unversioned(F.col("x")), x="AB123456.2") == "AB123456"


def test_first_contained_follows_list_order(one):
    assert one(text.first_contained(F.col("x"), ["Delft", "Utrecht"]), x="utrecht/DELFT/1") == "Delft"
    assert one(text.first_contained(F.col("x"), ["Delft"]), x="none") is None


def test_major_group(one):
    groups = {"HFMD": "HFMD", "Rash": "Skin"}
    assert one(text.major_group(F.col("x"), groups), x="Rash; HFMD; odd") == "HFMD; Skin"
    assert one(text.major_group(F.col("x"), groups), x="Skin") == "Skin"
    assert one(text.major_group(F.col("x"), groups), x="odd") is None


SYMPTOMS = {"Cough": "Respiratory", "fever": "Fever", "v&d": "Vomiting; Diarrhea"}


@pytest.mark.parametrize(
    "raw, want",
    [
        ("Homo sapiens; female; 2 years", ("Homo sapiens", "homo", "F", 2.0, 24.0, None)),
        ("boy 5 months stool", (None, "Stool", "M", 0.417, 5.0, None)),
        ("child, two years 3 months, cough and fever", ("Child", "child,", None, 2.25, 27.0, "Fever; Respiratory")),
        ("73 days", (None, None, None, 0.2, 2.4, None)),
        ("7 h", (None, None, "M", None, None, None)),
    ],
)
def test_mine_host_text(one, raw, want):
    got = tuple(one(mining.mine_host_text(F.col("x"), SYMPTOMS), x=raw))
    assert got == want


def test_two_ages_of_one_unit_do_not_fail(one):
    assert one(mining.mine_ages(F.col("x")), x="3 months and 6 months")["age_yrs"] == 0.5


def test_mining_genotype_and_severity(one):
    assert one(mining.mine_genotype(F.col("x")), x="new C4a subgenogroup") == "C4a"
    assert one(mining.mine_genotype(F.col("x")), x="Subgenogroup B5 found") == "Sub"
    assert one(mining.mine_genotype(F.col("x")), x="type B5 found") == "B5"
    assert one(mining.mine_genotype(F.col("x"), F.lit("genogroup: C1")), x="type B") == "C1"
    assert one(mining.mine_severity(F.lit("HFMD"), F.lit("severity score: high; outcome: died"))) == "HFMD; severity high; died"
    assert one(mining.mine_severity(F.lit(None).cast("string"), F.lit("score 3"))) is None


def test_precedence(one):
    none = F.lit(None).cast("string")
    assert one(precedence.pick_name(F.lit("b"), F.lit("k"), F.lit("k"))) == "b"
    assert one(precedence.pick_name(F.lit("k"), F.lit("e"), F.lit("k"))) == "e"
    assert one(precedence.pick_name(none, F.lit("e"), F.lit("k"))) == "e"
    assert one(precedence.pick_name(F.lit("b"), none, F.lit("k"))) == "b"
    assert one(precedence.pick_date(F.lit("2001"), F.lit("XXXX-XX-XX"), none)) == "2001"
    assert one(precedence.pick_date(F.lit("2001"), F.lit("XXXX-XX-XX"), F.lit("date_correction"))) == "XXXX-XX-XX"
    assert one(precedence.pick_longest(F.lit("ab"), F.lit("abc"))) == "abc"
    assert one(precedence.pick_longest(F.lit("ab"), none)) == "ab"
    assert one(precedence.replace_unless(F.lit(False), F.lit("own"), none)) == "own"
    assert one(precedence.replace_unless(F.lit(True), F.lit("own"), F.lit("over"))) == "own"


def _translate(seq: str) -> str:
    table = sequence.codon_table()
    return "".join(table.get(seq[i : i + 3], "X") for i in range(0, len(seq) - 2, 3))


@pytest.mark.parametrize("seq", ["", "AT", "ATG", "ATGTAAN", "ATGNNNTTTAC-GGG", "AAAAAAAAACCC", "TTTTTCTTATTGCTTCTCCTACTG"])
def test_translate(one, seq):
    assert one(sequence.translate_seq(F.col("x")), x=seq) == _translate(seq)


def test_composition_adds_up(one):
    for seq in ("ACGTN-RY?x1é", "", "acgt"):
        cells = sequence.composition(F.col("x"))
        got = {k: one(v, x=seq) for k, v in cells.items()}
        assert got.pop("length") == len(seq) == sum(got.values())


def test_windows_and_projection(one):
    assert one(sequence.mask_outside(F.col("x"), F.lit(3), F.lit(4)), x="ACGTAC") == "--GT--"
    assert one(sequence.mask_outside(F.col("x"), F.lit(3), F.lit(4)), x="ACNNAC") is None
    assert one(sequence.mask_outside(F.col("x"), F.lit(9), F.lit(10)), x="ACGT") is None
    assert one(sequence.project(F.col("x"), F.lit(2), 6), x="ACG") == "--ACG-"
    assert one(sequence.project(F.col("x"), F.lit(-1), 4), x="ACGTTT") == "CGTT"
    assert one(sequence.project(F.col("x"), F.lit(9), 4), x="ACG") == "----"
    assert one(sequence.ungapped_length(F.col("x"), 2, 4), x="A-NCGT") == 1


def test_differences_skip_unknown_letters(one):
    got = one(sequence.differences(F.lit("ACNT-GG"), F.lit("AGATCT")))
    assert [tuple(g) for g in got] == [(2, "G", "C"), (6, "T", "G")]
    assert one(sequence.differences(F.lit(""), F.lit("A"))) in (None, [])


def test_pairwise_identity(one):
    assert one(sequence.pairwise_identity(F.lit("ACGT"), F.lit("ACGA"))) == 0.75
    assert one(sequence.pairwise_identity(F.lit("ACGT"), F.lit("AC"))) == 0.5
