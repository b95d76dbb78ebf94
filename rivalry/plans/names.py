"""Column names of the stored tables."""

from __future__ import annotations

# Raw page classes and labels.
LIST_ROW_CLASS = "b-statistics__table-row"
LIST_LINK_CLASS = "b-link b-link_style_black"
LIST_DATE_CLASS = "b-statistics__date"
TITLE_CLASS = "b-content__title"
PERSON_CLASS = "b-fight-details__person"
PERSON_STATUS_CLASS = "b-fight-details__person-status"
PERSON_LINK_CLASS = "b-link b-fight-details__person-link"
BOUT_CLASS = "b-fight-details__fight-title"
DETAILS_CLASS = "b-fight-details__content"
DETAIL_LABEL_CLASS = "b-fight-details__label"
PROFILE_NAME_CLASS = "b-content__title-highlight"
PROFILE_RECORD_CLASS = "b-content__title-record"
PROFILE_NICKNAME_CLASS = "b-content__Nickname"
PROFILE_LIST_CLASS = "b-list__box-list"
WEIGHT_CLASS_HEADER = "Weight class"
RECORD_LABEL = "Record:"

# Raw column names.
RAW_EVENT = ["name", "date", "location", "url"]
RAW_WEIGHTS = ["Fight Url", "Weight Class"]
FIGHT_ID = "Fight ID"
WEIGHT_CLASS = "Weight Class"
STATUSES = ["Fighter1 Status", "Fighter2 Status"]
SIDES = ["Fighter1", "Fighter2"]
SIDE = "Fighter"

# Roles of the cleaned and derived columns.
TIME = "event_date"
CONTEST = "fight_id"
ENTITY = "fighter_id"
OPPONENT = "opponent_id"
WIN = "fight_fighter_win"
OPPONENT_WIN = "fight_opponent_win"
KEYS = [TIME, CONTEST, ENTITY, OPPONENT]
TO_OPPONENT = ("fighter", "opponent")
TO_OPPONENT_PREFIX = ("fighter_", "opponent_")
PROFILE_COLUMNS = [
    "fighter_id",
    "fighter_name",
    "fighter_nickname",
    "fighter_stance",
    "fighter_dob",
    "fighter_height_inches",
    "fighter_reach_inches",
]
BODY_COLUMNS = ["fighter_height_inches", "fighter_age", "fighter_reach_inches"]
UNUSED_STANCES = ["fighter_stance_sideways", "opponent_stance_sideways"]

# Feature parameters.
ROUNDS = [1, 2, 3, 4, 5]
ROLLING = [1, 3, 5, 10, 20]
EVEN_RATE = 0.5
SPARSE_SHARE = 0.5
SPARSE_MARKS = ["round4", "round5"]
TEST_SHARE = 0.25
SEED = 42
