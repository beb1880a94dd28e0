from pyspark.sql import functions as F

from corpusmill.config import SpecialCharacterConfig
from corpusmill.operators import rules
from corpusmill.operators.language import LanguageModel


def passed(result):
    return result.passed.first().passed


def test_special_characters(spark):
    rule = rules.SpecialCharacterRule(
        SpecialCharacterConfig(max_special_char_ratio=0.1, allowed_special_chars=(".", ",", "!", "?"))
    )
    good = spark.createDataFrame([("Normal text.",), ("Another normal text!",), (None,)], "text string")
    assert passed(rule.validate(good))
    bad = spark.createDataFrame([(1, "Text @#$%^&* with too many special chars!!!!!!!")], "id int, text string")
    result = rule.validate(bad, "id")
    assert not passed(result)
    issue = result.issues.first()
    assert issue.message == (
        "High special character ratio (0.15) in text: Text @#$%^&* with too many special chars!!!!!!!..."
    )
    assert (issue.row_key, result.stats.first().violations) == ("1", 1)


def test_code_and_urls_are_not_special(spark):
    rule = rules.SpecialCharacterRule()
    rows = spark.createDataFrame([("```@@@@@@@@``` `####` https://a.b/%%%%%% ok",)], "text string")
    assert passed(rule.validate(rows))
    strict = rules.SpecialCharacterRule(SpecialCharacterConfig(exclude_code_blocks=False))
    assert not passed(strict.validate(rows))


def test_long_url_does_not_overflow_the_stack(spark):
    rows = spark.createDataFrame([("https://" + "a%20" * 50_000,)], "text string")
    assert passed(rules.SpecialCharacterRule().validate(rows))


def test_column_without_texts_has_zero_statistics(spark):
    rows = spark.createDataFrame([(None,)], "text string")
    assert tuple(rules.SpecialCharacterRule().stats(rows).first()) == ("text", 0.0, 0.0, 0)


ENGLISH = ["This is English text.", "Another English sentence.", "The weather is nice and the sun shines there."]
SPANISH = ["Esto es texto en español.", "El tiempo es bueno y el sol brilla en la ciudad.", "Otra frase más en español."]


def test_language_consistency(spark):
    training = spark.createDataFrame([(t, "en") for t in ENGLISH] + [(t, "es") for t in SPANISH], "text string, lang string")
    model = LanguageModel.train(training, "text", "lang")
    rule = rules.LanguageConsistencyRule(model)
    assert passed(rule.validate(spark.createDataFrame([(t,) for t in ENGLISH[:2]], "text string")))
    mixed = spark.createDataFrame([(1, ENGLISH[0]), (2, SPANISH[0]), (3, "short")], "id int, text string")
    result = rule.validate(mixed, "id")
    assert not passed(result)
    messages = {r.row_key: r.message for r in result.issues.collect()}
    assert messages["2"].startswith("Text detected as es (confidence: 1.00): Esto es texto")
    assert messages[None] == "Column text has low primary language ratio: 0.50"
    stats = result.stats.first()
    assert (stats.detected_languages, stats.violations) == (["en", "es"], 1)


def test_language_model_survives_saving(spark, tmp_path):
    training = spark.createDataFrame([(t, "en") for t in ENGLISH] + [(t, "es") for t in SPANISH], "text string, lang string")
    model = LanguageModel.train(training, "text", "lang")
    model.save(str(tmp_path / "model"))
    again = LanguageModel.load(spark, str(tmp_path / "model"))
    texts = spark.createDataFrame([("the sun",), ("el sol brilla",), ("42",), (None,)], "t string")
    assert model.detect(texts, "t").collect() == again.detect(texts, "t").collect()
    found = {r.t: r.language for r in again.detect(texts, "t").collect()}
    assert found["the sun"].language == "en" and found["el sol brilla"].language == "es"
    assert tuple(found["42"]) == (None, 0.0) and found[None] is None


def test_formats(spark):
    rule = rules.DataFormatRule()
    good = spark.createDataFrame(
        [("test@example.com", "+1234567890", "2024-01-01"), ("another@email.com", "1234567890", "2024-12-31")],
        "email string, phone string, date string",
    )
    assert passed(rule.validate(good))
    bad = spark.createDataFrame(
        [(1, "not-an-email", "123", "2024/01/01"), (2, "invalid@", "not-a-phone", "invalid-date")],
        "id int, email string, phone string, date string",
    )
    assert not passed(rule.validate(bad))
    assert {r.column: r.invalid_count for r in rule.stats(bad).collect()} == {"email": 2, "phone": 2, "date": 2}
    examples = rule.examples(bad, "id").where("column = 'email'").orderBy("position").collect()
    assert [r.value for r in examples] == ["not-an-email", "invalid@"]


def test_typed_values_and_overrides(spark):
    rows = spark.createDataFrame([(7, "x")], "update_count int, mail string")
    rule = rules.DataFormatRule(column_formats={"mail": "email"})
    assert {r.column for r in rule.stats(rows).collect()} == {"update_count", "mail"}


def dates(spark, *rows):
    return spark.createDataFrame(list(rows), "start_date string, end_date string")


def test_cross_field(spark):
    rule = rules.CrossFieldConsistencyRule().add_relationship(
        ["start_date", "end_date"], rules.date_order_violation(), "start after end"
    )
    good = dates(spark, ("2024-01-01", "2024-01-31"), ("2024-02-01", "2024-02-28"), (None, "2024-01-01"))
    assert passed(rule.validate(good))
    bad = dates(spark, ("2024-02-01", "2024-01-31"), ("2024-03-01", "2024-03-28"))
    assert not passed(rule.validate(bad))
    assert rule.stats(bad).first().violations == 1
    by_function = rules.CrossFieldConsistencyRule().add_relationship(
        ["start_date", "end_date"], lambda df: df.where("start_date > end_date"), "start after end"
    )
    assert by_function.stats(bad).first().violations == 1
    absent = rules.CrossFieldConsistencyRule().add_relationship(["a", "end_date"], F.lit(True), "x")
    assert absent.issues(bad).first().message == "Missing required fields for validation: ['a']"


def test_date_order(spark):
    frame = dates(spark, ("2024-02-01", "2024-01-31"), ("x", "2024-01-01"), ("2024/01/05", "2024-01-04"), (None, None))
    row = rules.date_order(frame).first()
    assert (row.start_after_end, row.unparsable, row.passed) == (2, 1, False)


class NoEmptyText(rules.Rule):
    name = "No empty text"

    def issues(self, df, row_key=None):
        return df.where("text = ''").select(
            *self._issue(F.lit("text"), F.lit(None), F.lit("empty"))
        )

    def stats(self, df):
        return df.agg(F.count_if(F.col("text") == "").alias("violations"))


def test_rules_can_be_added(spark):
    result = NoEmptyText().validate(spark.createDataFrame([("",), ("a",)], "text string"))
    assert not passed(result) and result.stats.first().violations == 1
    both = rules.all_issues(
        spark.createDataFrame([("",), ("@#%^@#%^",)], "text string"),
        [NoEmptyText(), rules.SpecialCharacterRule()],
    )
    assert sorted(r.rule for r in both.collect()) == ["No empty text", "Special Character Validation"]


def test_a_failing_relationship_is_an_issue(spark):
    def fails(df):
        raise ValueError("no rates today")

    df = spark.createDataFrame([(1, 2)], "a int, b int")
    rule = rules.CrossFieldConsistencyRule()
    rule.add_relationship(["a"], fails, "fails")
    rule.add_relationship(["a"], lambda d: d.where("nothing > 1"), "unknown column")
    rule.add_relationship(["a", "b"], F.col("a") < F.col("b"), "a below b")
    found = [r.message for r in rule.issues(df).collect()]
    assert "Found 1 violations of: a below b" in found
    assert "Validation failed for fields ['a']: no rates today" in found
    assert len(found) == 3
