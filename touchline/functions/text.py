"""Text functions of the warehouse: goal lines, scores, names and image paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_STAGE = "no_stage_name"


def _replace(text: Column, search: str, substitute: str) -> Column:
    return F.replace(text, F.lit(search), F.lit(substitute))


def short_name(name: Column) -> Column:
    return F.lower(_replace(name, " ", ""))


def flag_image(country_code: Column) -> Column:
    return F.lower(F.concat(country_code, F.lit(".svg")))


def team_image(team_name: Column) -> Column:
    return F.concat(F.lit("assets/images/"), team_name, F.lit(".png"))


def score_text(
    home: Column, away: Column, shootout_home: Column, shootout_away: Column, strict: bool = False
) -> Column:
    """``2:1``, or ``2(4):2(3)`` after a shoot-out.

    The long form needs a non-zero home count; ``strict`` only asks for a known one.
    """
    shown = shootout_home.isNotNull() if strict else (shootout_home != 0)
    plain = F.concat(home.cast("string"), F.lit(":"), away.cast("string"))
    long = F.concat(
        home.cast("string"), F.lit("("), shootout_home.cast("string"), F.lit("):"),
        away.cast("string"), F.lit("("), shootout_away.cast("string"), F.lit(")"),
    )
    return F.when(shown, long).otherwise(plain)


def goal_line(minute: Column, description: Column) -> Column:
    """Readable goal text from the minute and the first entry of the description document."""
    sentence = F.get_json_object(description, "$[0].Description")
    sentence = _replace(_replace(sentence, '"', ""), "scores!!", "")
    line = _replace(F.concat(minute, sentence), "'", "` ")
    return _replace(_replace(line, "successfully converts the penalty", "pen"), "!", "")


def scorer_line(minute: Column, player: Column, country_code: Column) -> Column:
    return F.concat(minute.cast("string"), F.lit("` "), player, F.lit("("), country_code, F.lit(")"))


def is_goal_type(type_text: Column) -> Column:
    folded = F.lower(type_text)
    return folded.like("%goal%") & ~folded.like("%attempt%")


def stage_name(group_name: Column, round_name: Column) -> Column:
    """The group's name, else the round's."""
    return F.coalesce(group_name, round_name)


def named_stage(stage: Column) -> Column:
    return F.when(stage == "", F.lit(NO_STAGE)).otherwise(stage)
