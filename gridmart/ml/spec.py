"""Columns and settings of the play-success model."""

# What the model reads.
ID_COLUMNS = "game_id play_id".split()
NUMERIC = """
season nfl_week qtr down ydstogo yardline_100 drive game_seconds_remaining half_seconds_remaining
score_differential goal_to_go shotgun no_huddle posteam_timeouts_remaining
defteam_timeouts_remaining temperature wind
""".split()
CATEGORICAL = "offense_franchise_id defense_franchise_id offense_home_away roof surface".split()
TARGET = "is_successful_play"
MAX_ITERATIONS = 1000
INVERSE_PENALTY = 1.0

DUMMY = "dummy_classifier"
LOGISTIC = "logistic_regression"
METRICS = "accuracy precision recall f1 confusion_matrix roc_auc".split()
