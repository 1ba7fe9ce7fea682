"""Declared schemas of the landed tables, so that reading them needs no inference pass.

Measured values stay text where sources deliver text; the operators parse them."""

from __future__ import annotations

IDENTIFIERS = (
    "sams_player_id int, sams_mrn string, sams_name string, whoop_id string, firstbeat_id string, "
    "vald_id string, gymaware_id string, runscribe_id string, smartabase_name string, "
    "whoop_name string, firstbeat_name string, vald_name string")

JUMP_RESULTS = ("vald_id string, test_type string, metric_name string, limb string, "
                "trial_limb string, recorded_date date, value string")
REBOUND_RESULTS = "vald_id string, test_name string, field string, test_date date, value string"

RECOVERY = ("whoop_user_id int, recorded_date date, recovery_score double, "
            "hrv_rmssd_milli double, resting_heart_rate double")
STRAIN = "whoop_user_id int, recorded_date date, strain double, calories double"
SLEEP = ("whoop_user_id int, start_time string, total_sleep_mins double, "
         "sleep_performance double, deep_sleep_mins double, rem_sleep_mins double, "
         "light_sleep_mins double, awake_mins double")

LOAD_SESSIONS = ("athlete_id string, date string, startTime string, durationMinutes double, "
                 "trimp double, calories double, aerobicTE double, acwr double")

ANTHRO_RECORDS = ("player_id int, mrn string, athlete_name string, level string, "
                  "date_of_birth string, date_of_measure date, measurements string, "
                  "maturation string")
SKELETAL_AGE = (
    "sams_id int, mrn string, sams_name string, source_name string, record_date string, "
    "current_age string, fels string, g_p2 string, tw3 string, tw22 string, height_cm string, "
    "height_prediction string, predicted_adult_height_reached string, "
    "maturity_status_interim string, maturity_status string, phv_predicted_height_status string, "
    "notes string")

EVENT_PERCENTILES = "event string, age_bin string, " + ", ".join(
    f"p{p} double" for p in range(0, 101, 5))
STANDARDS = ("event_standard string, sex string, standard_numeric double, standard_raw string, "
             "metric string, lower_is_better boolean")
RESULTS = "Start_Date string, Event_standard string, Result_numerical string"

PRODUCTS = "id int, name string, brand string, unit string, active int"
RECEIPTS = "product_id int, quantity double"
ASSIGNMENTS = ("sams_player_id int, athlete_name string, sport string, product_id int, "
               "quantity double, unit string, reason string, assigned_by string, note string, "
               "assigned_at string")

PLAYERS = ("playerId int, fullName string, playerName string, name string, arabicName string, "
           "mrn string, sportId int, currentSportName string, dateOfBirth string, gender string, "
           "isActive boolean, pathway string, imageUrl string, profileImageUrl string")
ENROLLMENT_PERIODS = (
    "playerId int, isPrimary boolean, startDate string, endDate string, sportId int, "
    "sportName string, disciplineId int, disciplineName string, targetEventNames string, "
    "playerTypeName string, coachName string")
TRAINING_PLANS = "trainingPlanId int, SportId int, TrainingDate string, CommitteeId int"
