"""Columns of the two published extracts and the states they cover."""

# Fixed values.
STATES = ("AZ", "CA", "FL", "NV", "MD")

SCORECARD_COLUMNS = [
    "CMS_ID",
    "Ecosystem_Name",
    "provider_name",
    "address",
    "city",
    "state",
    "zip_code",
    "county",
    "County_count",
    "State_Srv",
    "Ownership_Type",
    "Lab_Service_Binary",
    "Pharm_Service_Binary",
    "Nursing_Service_Binary",
    "PT_Service_Binary",
    "OT_Service_Binary",
    "Speech_Service_Binary",
    "Med_SS_Service_Binary",
    "HH_Aide_Service_Binary",
    "date_certified",
    "quality_of_patient_care_star_rating",
    "hhcahps_survey_summary_star_rating",
    "how_often_the_home_health_team_began_their_patients’_care_in_a_timely_manner",
    "qm_timely_manner_county_ptile",
    "qm_timely_manner_ptile",
    "how_often_the_home_health_team_taught_patients_or_their_family_caregivers_about_their_drugs",
    "qm_teach_drugs_county_ptile",
    "qm_teach_drugs_ptile",
    "how_often_the_home_health_team_checked_patients’_risk_of_falling",
    "qm_risk_falling_county_ptile",
    "qm_risk_falling_ptile",
    "how_often_the_home_health_team_checked_patients_for_depression",
    "qm_depression_county_ptile",
    "qm_depression_ptile",
    "how_often_the_home_health_team_determined_whether_patients_received_a_flu_shot_for_the_currnet_flu_season",
    "qm_flu_shot_county_ptile",
    "qm_flu_shot_ptile",
    "how_often_the_home_health_team_made_sure_that_their_patients_have_received_a_pneumococcal_vaccine_pneumonia_shot",
    "qm_pneum_shot_county_ptile",
    "qm_pneum_shot_ptile",
    "with_diabetes_how_often_the_home_health_team_got_doctor’s_orders_gave_foot_care_and_taught_patients_about_foot_care",
    "qm_diabetes_footcare_county_ptile",
    "qm_diabetes_footcare_ptile",
    "how_often_patients_got_better_at_walking_or_moving_around",
    "qm_improv_mobil_county_ptile",
    "qm_improv_mobil_ptile",
    "how_often_patients_got_better_at_getting_in_and_out_of_bed",
    "qm_improv_trans_county_ptile",
    "qm_improv_trans_ptile",
    "how_often_patients_got_better_at_bathing",
    "qm_bathing_county_ptile",
    "qm_bathing_ptile",
    "how_often_patients_had_less_pain_when_moving_around",
    "qm_pain_moving_county_ptile",
    "qm_pain_moving_ptile",
    "how_often_patients’_breathing_improved",
    "qm_breathing_county_ptile",
    "qm_breathing_ptile",
    "how_often_patients’_wounds_improved_or_healed_after_an_operation",
    "qm_improv_wounds_county_ptile",
    "qm_improv_wounds_ptile",
    "how_often_patients_got_better_at_taking_their_drugs_correctly_by_mouth",
    "qm_correct_meds_county_ptile",
    "qm_correct_meds_ptile",
    "how_often_home_health_patients_had_to_be_admitted_to_the_hospital",
    "qm_admit_hosp_ptile",
    "qm_hosp_admit_ptile_rank",
    "how_often_patients_receiving_home_health_care_needed_urgent_unplanned_care_in_the_er_without_being_admitted",
    "qm_urgent_care_norehosp_county_ptile",
    "qm_urgent_care_no_hosp_ptile",
    "qm_urgent_care_no_hosp_rank",
    "how_often_home_health_patients_who_have_had_a_recent_hospital_stay_had_to_be_re-admitted_to_the_hospital",
    "qm_pac_hosp_admitt_rank",
    "how_often_home_health_patients_who_have_had_a_recent_hospital_stay_received_care_in_the_hospital_emergency_room_without_being_readmitted_to_the_hospital",
    "qm_pac_urgent_care_no_hosp_rank",
    "pred_all_diff_ptile_rank",
    "pred_med_diff_ptile_rank",
    "pred_chf_diff_ptile_rank",
    "pred_med_high_diff_ptile_rank",
    "pred_med_low_diff_ptile_rank",
    "pred_surg_high_risk_diff_ptile_rank",
    "pred_surg_diff_ptile_rank",
    "pred_surg_low_risk_diff_ptile_rank",
    "pred_lung_diff_ptile_rank",
    "pred_all_comp_rate",
    "pred_all_state_rate",
    "pred_med_other_comp_rate",
    "pred_med_other_state_rate",
    "pred_surg_other_comp_rate",
    "pred_surg_other_state_rate",
    "pred_CHF_comp_rate",
    "pred_CHF_state_rate",
    "pred_med_high_comp_rate",
    "pred_med_high_state_rate",
    "pred_med_low_comp_rate",
    "pred_med_low_state_rate",
    "pred_surg_high_comp_rate",
    "pred_surg_high_state_rate",
    "pred_surg_low_comp_rate",
    "pred_surg_low_state_rate",
    "pred_lung_diff_comp_rate",
    "pred_lung_diff_state_rate",
    "percent_of_patients_who_reported_that_their_home_health_team_gave_care_in_a_professional_way",
    "hcaps_prof_care_county_ptile",
    "hcaps_prof_care_ptile",
    "percent_of_patients_who_reported_that_their_home_health_team_communicated_well_with_them",
    "hcaps_communicated_county_ptile",
    "hcaps_communicated_ptile",
    "hcaps_definitely_recommend_county_ptile",
    "hcaps_definitely_recommend_ptile",
    "hcaps_discuss_med_county_ptile",
    "hcaps_discuss_med_ptile",
    "percent_of_patients_who_reported_that_their_home_health_team_discussed_medicines_pain_and_home_safety_with_them",
    "percent_of_patients_who_gave_their_home_health_agency_a_rating_of_9_or_10_on_a_scale_from_0_lowest_to_10_highest",
    "hcaps_above_8_county_ptile",
    "hcaps_above_8_ptile",
    "percent_of_patients_who_reported_yes_they_would_definitely_recommend_the_home_health_agency_to_friends_and_family",
    "alleg_state_mean",
    "alleg_total",
    "rehosp_alleg_state_mean",
    "sub_alleg_state_mean",
    "sub_alleg_sum",
    "total_weight_alleg",
    "alleg_county_mean",
    "total_sub_alleg",
    "total_rehosp_alleg",
    "sub_alleg_county_mean",
    "rehosp_alleg_county_mean",
    "def_county_mean",
    "def_state_mean",
    "def_total",
    "comp_bin_county_mean",
    "comp_bin_state_mean",
    "number_of_completed_surveys",
    "response_rate",
    "CRTFCTN_DT",
    "CRTFCTN_UPDT_DT",
    "Reporting_Month",
    "tagcount_lastsurv",
    "tagcount_complaint",
]

NETWORK_COLUMNS = [
    "provider_name",
    "CMS_ID",
    "county",
    "Ownership_Type",
    "address",
    "city",
    "state",
    "zip_code",
    "quality_of_patient_care_star_rating",
    "hhcahps_survey_summary_star_rating",
    "percent_of_patients_who_reported_that_their_home_health_team_discussed_medicines_pain_and_home_safety_with_them",
    "percent_of_patients_who_reported_that_their_home_health_team_communicated_well_with_them",
    "how_often_home_health_patients_had_to_be_admitted_to_the_hospital",
    "alleg_total",
    "def_total",
    "pred_med_high_diff_ptile_rank",
    "pred_med_high_comp_rate",
    "pred_med_low_diff_ptile_rank",
    "pred_med_low_comp_rate",
    "pred_surg_high_risk_diff_ptile_rank",
    "pred_surg_high_comp_rate",
    "pred_surg_low_risk_diff_ptile_rank",
    "pred_surg_low_comp_rate",
    "pred_chf_diff_ptile_rank",
    "pred_CHF_comp_rate",
    "pred_lung_diff_ptile_rank",
    "pred_lung_diff_comp_rate",
    "pred_med_diff_ptile_rank",
    "pred_med_other_comp_rate",
    "pred_surg_diff_ptile_rank",
    "pred_surg_other_comp_rate",
]
