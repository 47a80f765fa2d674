"""The 21 published measures: short name, source header and percentile names."""

from __future__ import annotations

from typing import NamedTuple


class Measure(NamedTuple):
    name: str
    header: str
    state_rank: str
    county_rank: str


# Fixed values.
MEASURES: list[Measure] = [
    Measure(
        "m_qm_timely_manner",
        "how_often_the_home_health_team_began_their_patients’_care_in_a_timely_manner",
        "qm_timely_manner_ptile",
        "qm_timely_manner_county_ptile",
    ),
    Measure(
        "m_qm_teach_drugs",
        "how_often_the_home_health_team_taught_patients_or_their_family_caregivers_about_their_drugs",
        "qm_teach_drugs_ptile",
        "qm_teach_drugs_county_ptile",
    ),
    Measure(
        "m_qm_risk_falling",
        "how_often_the_home_health_team_checked_patients’_risk_of_falling",
        "qm_risk_falling_ptile",
        "qm_risk_falling_county_ptile",
    ),
    Measure(
        "m_qm_depression",
        "how_often_the_home_health_team_checked_patients_for_depression",
        "qm_depression_ptile",
        "qm_depression_county_ptile",
    ),
    Measure(
        "m_qm_flu_shot",
        "how_often_the_home_health_team_determined_whether_patients_received_a_flu_shot_for_the_currnet_flu_season",
        "qm_flu_shot_ptile",
        "qm_flu_shot_county_ptile",
    ),
    Measure(
        "m_qm_pneum_shot",
        "how_often_the_home_health_team_made_sure_that_their_patients_have_received_a_pneumococcal_vaccine_pneumonia_shot",
        "qm_pneum_shot_ptile",
        "qm_pneum_shot_county_ptile",
    ),
    Measure(
        "m_qm_diabetes_footcare",
        "with_diabetes_how_often_the_home_health_team_got_doctor’s_orders_gave_foot_care_and_taught_patients_about_foot_care",
        "qm_diabetes_footcare_ptile",
        "qm_diabetes_footcare_county_ptile",
    ),
    Measure(
        "m_qm_improv_mobil",
        "how_often_patients_got_better_at_walking_or_moving_around",
        "qm_improv_mobil_ptile",
        "qm_improv_mobil_county_ptile",
    ),
    Measure(
        "m_qm_improv_trans",
        "how_often_patients_got_better_at_getting_in_and_out_of_bed",
        "qm_improv_trans_ptile",
        "qm_improv_trans_county_ptile",
    ),
    Measure(
        "m_qm_bathing",
        "how_often_patients_got_better_at_bathing",
        "qm_bathing_ptile",
        "qm_bathing_county_ptile",
    ),
    Measure(
        "m_qm_pain_moving",
        "how_often_patients_had_less_pain_when_moving_around",
        "qm_pain_moving_ptile",
        "qm_pain_moving_county_ptile",
    ),
    Measure(
        "m_qm_breathing",
        "how_often_patients’_breathing_improved",
        "qm_breathing_ptile",
        "qm_breathing_county_ptile",
    ),
    Measure(
        "m_qm_improv_wounds",
        "how_often_patients’_wounds_improved_or_healed_after_an_operation",
        "qm_improv_wounds_ptile",
        "qm_improv_wounds_county_ptile",
    ),
    Measure(
        "m_qm_correct_meds",
        "how_often_patients_got_better_at_taking_their_drugs_correctly_by_mouth",
        "qm_correct_meds_ptile",
        "qm_correct_meds_county_ptile",
    ),
    Measure(
        "m_qm_admit_hosp",
        "how_often_home_health_patients_had_to_be_admitted_to_the_hospital",
        "qm_admit_hosp_ptile",
        "qm_admit_hosp_county_ptile",
    ),
    Measure(
        "m_qm_urgent_care_no_hosp",
        "how_often_patients_receiving_home_health_care_needed_urgent_unplanned_care_in_the_er_without_being_admitted",
        "qm_urgent_care_no_hosp_ptile",
        "qm_urgent_care_norehosp_county_ptile",
    ),
    Measure(
        "m_hcaps_prof_care",
        "percent_of_patients_who_reported_that_their_home_health_team_gave_care_in_a_professional_way",
        "hcaps_prof_care_ptile",
        "hcaps_prof_care_county_ptile",
    ),
    Measure(
        "m_hcaps_communicated",
        "percent_of_patients_who_reported_that_their_home_health_team_communicated_well_with_them",
        "hcaps_communicated_ptile",
        "hcaps_communicated_county_ptile",
    ),
    Measure(
        "m_hcaps_discuss_med",
        "percent_of_patients_who_reported_that_their_home_health_team_discussed_medicines_pain_and_home_safety_with_them",
        "hcaps_discuss_med_ptile",
        "hcaps_discuss_med_county_ptile",
    ),
    Measure(
        "m_hcaps_above_8",
        "percent_of_patients_who_gave_their_home_health_agency_a_rating_of_9_or_10_on_a_scale_from_0_lowest_to_10_highest",
        "hcaps_above_8_ptile",
        "hcaps_above_8_county_ptile",
    ),
    Measure(
        "m_hcaps_definitely_recommend",
        "percent_of_patients_who_reported_yes_they_would_definitely_recommend_the_home_health_agency_to_friends_and_family",
        "hcaps_definitely_recommend_ptile",
        "hcaps_definitely_recommend_county_ptile",
    ),
]

QUALITY = [m for m in MEASURES if m.name.startswith("m_qm_")]
SURVEY = [m for m in MEASURES if m.name.startswith("m_hcaps_")]

# Text measures kept under their own headers (fixed values).
READMITTED = "how_often_home_health_patients_who_have_had_a_recent_hospital_stay_had_to_be_re-admitted_to_the_hospital"
EMERGENCY = "how_often_home_health_patients_who_have_had_a_recent_hospital_stay_received_care_in_the_hospital_emergency_room_without_being_readmitted_to_the_hospital"
