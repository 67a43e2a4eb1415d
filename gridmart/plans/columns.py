"""Output columns of the stored tables.

Fixed values: names and order of the published columns.
"""

DIM_FRANCHISE = "franchise_id franchise_name team_code conference division".split()

DIM_TEAM_CODE = "source_team_code team_code franchise_id".split()

DIM_GAME = """
game_id season game_type week gameday weekday gametime away_team home_team game_location overtime
old_game_id gsis nfl_detail_id pfr pff espn ftn div_game roof surface temperature wind
away_qb_id home_qb_id away_qb_name home_qb_name away_coach home_coach referee stadium_id stadium
home_franchise_id home_team_code away_franchise_id away_team_code
""".split()

SCHEDULE_MEASURES = """
home_score away_score total game_result away_rest home_rest away_moneyline home_moneyline
spread_line away_spread_odds home_spread_odds total_line under_odds over_odds
""".split()

GAME_MEASURES = "play_count no_play_count real_play_count epa_sum success_rate".split()

DIM_PLAYER = """
player_id full_name first_name last_name birth_date height espn_id pfr_id entry_year rookie_year
draft_club draft_number
""".split()

DIM_PLAYER_SEASON = """
player_id season franchise_id player_position jersey_number years_exp weight
""".split()

DIM_DATE = """
date date_key year quarter month month_name day day_of_week_num day_of_week_name week_of_year
""".split()

FCT_PLAY = """
game_id play_id season nfl_week qtr down ydstogo yardline_100 play_type play_desc
offense_franchise_id defense_franchise_id passer_player_id rusher_player_id receiver_player_id
yards_gained passing_yards rushing_yards receiving_yards yards_after_catch epa wp success
touchdown pass_touchdown rush_touchdown return_touchdown interception fumble fumble_lost
fumble_forced series drive penalty_team penalty_player_id penalty_player_name penalty_yards
penalty_type penalty
""".split()

FCT_PLAY_PASS = """
game_id play_id season nfl_week qtr drive down ydstogo yardline_100 play_type play_desc
offense_franchise_id defense_franchise_id passer_player_id receiver_player_id yards_gained
passing_yards receiving_yards yards_after_catch epa wp success touchdown pass_touchdown
interception fumble fumble_lost series penalty_team penalty_player_id penalty_player_name
penalty_yards penalty_type penalty posteam posteam_type defteam side_of_field game_date
quarter_seconds_remaining half_seconds_remaining game_seconds_remaining game_half goal_to_go
yrdln pass_attempt complete_pass incomplete_pass sack qb_hit qb_dropback qb_scramble qb_spike
qb_kneel shotgun no_huddle pass_length pass_location air_yards air_epa yac_epa comp_air_epa
comp_yac_epa air_wpa yac_wpa comp_air_wpa comp_yac_wpa wpa vegas_wpa first_down_pass
first_down_penalty third_down_converted third_down_failed fourth_down_converted
fourth_down_failed stg_pass_touchdown pass_flag play_flag special_flag two_point_attempt
two_point_conv_result aborted_play cpoe complete_pass_probability xpass pass_oe qb_epa xyac_epa
xyac_mean_yardage xyac_median_yardage xyac_success xyac_fd passer passer_jersey_number receiver
receiver_jersey_number sack_player_id sack_player_name half_sack_1_player_id
half_sack_1_player_name half_sack_2_player_id half_sack_2_player_name
""".split()

FCT_PLAY_RUSH = """
game_id play_id season nfl_week qtr drive down ydstogo yardline_100 play_type play_desc
offense_franchise_id defense_franchise_id rusher_player_id yards_gained rushing_yards epa wp
success touchdown rush_touchdown fumble fumble_lost fumble_forced series penalty_team
penalty_player_id penalty_player_name penalty_yards penalty_type penalty posteam posteam_type
defteam side_of_field game_date quarter_seconds_remaining half_seconds_remaining
game_seconds_remaining game_half goal_to_go yrdln rush_attempt sack qb_scramble qb_kneel
shotgun no_huddle run_location run_gap first_down_rush first_down_penalty third_down_converted
third_down_failed fourth_down_converted fourth_down_failed tackled_for_loss stg_rush_touchdown
rush_flag play_flag special_flag two_point_attempt two_point_conv_result aborted_play wpa
vegas_wpa qb_epa rusher rusher_jersey_number lateral_rush lateral_rusher_player_id
lateral_rusher_player_name lateral_rushing_yards
""".split()

FCT_PLAY_KICK = """
game_id play_id season nfl_week qtr drive down ydstogo yardline_100 play_type play_desc
offense_franchise_id defense_franchise_id yards_gained epa wp success touchdown
return_touchdown fumble fumble_lost series penalty_team penalty_player_id penalty_player_name
penalty_yards penalty_type penalty posteam posteam_type defteam side_of_field game_date
quarter_seconds_remaining half_seconds_remaining game_seconds_remaining game_half goal_to_go
yrdln special_teams_play st_play_type punt_attempt kickoff_attempt field_goal_attempt
extra_point_attempt punt_blocked field_goal_result extra_point_result kick_distance touchback
punt_inside_twenty punt_in_endzone punt_out_of_bounds punt_downed punt_fair_catch
kickoff_inside_twenty kickoff_in_endzone kickoff_out_of_bounds kickoff_downed
kickoff_fair_catch own_kickoff_recovery own_kickoff_recovery_td return_team return_yards
punt_returner_player_id punt_returner_player_name lateral_punt_returner_player_id
lateral_punt_returner_player_name kickoff_returner_player_id kickoff_returner_player_name
lateral_kickoff_returner_player_id lateral_kickoff_returner_player_name punter_player_id
punter_player_name kicker_player_id kicker_player_name own_kickoff_recovery_player_id
own_kickoff_recovery_player_name blocked_player_id blocked_player_name two_point_attempt
two_point_conv_result aborted_play wpa vegas_wpa home_opening_kickoff special_flag play_flag
""".split()

FCT_PLAY_PENALTY = """
game_id play_id season nfl_week qtr drive down ydstogo yardline_100 play_type play_desc
offense_franchise_id defense_franchise_id yards_gained epa wp success touchdown series
penalty_team penalty_player_id penalty_player_name penalty_yards penalty_type penalty posteam
posteam_type defteam side_of_field game_date quarter_seconds_remaining half_seconds_remaining
game_seconds_remaining game_half goal_to_go yrdln first_down_penalty replay_or_challenge
replay_or_challenge_result two_point_attempt two_point_conv_result aborted_play wpa vegas_wpa
play_type_nfl st_play_type special_teams_play play_flag special_flag pass_attempt rush_attempt
sack qb_scramble punt_attempt kickoff_attempt field_goal_attempt extra_point_attempt
""".split()

FCT_DRIVE = """
game_id drive offense_franchise_id drive_play_count yards_gained_sum epa_sum success_rate
drive_inside20 drive_ended_with_score
""".split()

FCT_GAME = (
    ["game_id", "home_franchise_id", "away_franchise_id"] + SCHEDULE_MEASURES + GAME_MEASURES
)

FCT_PLAYER_GAME = """
game_id player_id season nfl_week franchise_id opponent_franchise_id game_team_side play_count
no_play_count real_play_count passer_play_count rusher_play_count receiver_play_count epa_sum
""".split()

FEATURES = """
game_id play_id season nfl_week qtr down ydstogo yardline_100 drive offense_franchise_id
defense_franchise_id game_seconds_remaining half_seconds_remaining score_differential goal_to_go
shotgun no_huddle posteam_timeouts_remaining defteam_timeouts_remaining offense_home_away roof
surface temperature wind is_successful_play
""".split()

# Play columns that only the drive table and the feature table read.
DRIVE_INPUTS = "drive_play_count ydsnet drive_inside20 drive_ended_with_score".split()
FEATURE_INPUTS = """
home_team away_team score_differential posteam_timeouts_remaining defteam_timeouts_remaining
""".split()


def play_inputs() -> list[str]:
    """Every play-by-play source column that some stored table needs."""
    made = {
        "offense_franchise_id",
        "defense_franchise_id",
        "stg_pass_touchdown",
        "stg_rush_touchdown",
    }
    wanted = (
        FCT_PLAY
        + FCT_PLAY_PASS
        + FCT_PLAY_RUSH
        + FCT_PLAY_KICK
        + FCT_PLAY_PENALTY
        + DRIVE_INPUTS
        + FEATURE_INPUTS
    )
    return [c for c in dict.fromkeys(wanted) if c not in made]
