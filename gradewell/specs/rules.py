"""Threshold rules, small-volume limits and code lists of the scorecard."""

from __future__ import annotations

from gradewell.functions.flags import Rule

# Fixed values.
RULES: list[Rule] = [
    Rule("alleg_binary", "alleg_total", ">", 0),
    Rule("for_profit_binary", "GNRL_CNTL_TYPE_DESC", "==", "PROPRIETARY"),
    Rule("no_lab_service", "LAB_SRVC_DESC", "==", "NOT PROVIDED"),
    Rule("no_pharm_service", "PHRMCY_SRVC_DESC", "==", "NOT PROVIDED"),
    Rule("no_other_service", "OTHR_SRVC_DESC", "==", "NOT PROVIDED"),
    Rule("medicare_only_binary", "PGM_PRTCPTN_DESC", "==", "MEDICARE ONLY"),
    Rule("medical_admin_binary", "DSCPLN_ADMINR_DESC", "in", ("RN/LPN", "PHYSICIAN")),
    Rule("staff_nursing_fulltime_binary", "NRSNG_SRVC_DESC", "==", "PROVIDED BY STAFF"),
    Rule("staff_pt_fulltime_binary", "PT_SRVC_DESC", "==", "PROVIDED BY STAFF"),
    Rule("staff_ot_fulltime_binary", "OCPTNL_THRPST_SRVC_DESC", "==", "PROVIDED BY STAFF"),
    Rule("staff_speech_fulltime_binary", "SPCH_THRPY_SRVC_DESC", "==", "PROVIDED BY STAFF"),
    Rule("staff_medsoc_fulltime_binary", "MDCL_SCL_SRVC_DESC", "==", "PROVIDED BY STAFF"),
    Rule("staff_hhaide_fulltime_binary", "HH_AIDE_SRVC_DESC", "==", "PROVIDED BY STAFF"),
    Rule("no_hha_serv_binary", "HH_AIDE_SRVC_DESC", "==", "NOT PROVIDED"),
    Rule("staff_nutrit_fulltime_binary", "NTRTNL_GDNC_SRVC_DESC", "==", "NOT PROVIDED"),
    Rule("survey_good_care_binary", "SRVYR_SMRY_DESC", "==", "CARE THAT PROMOTES POTENTIAL"),
    Rule("qm_timely_manner_low_binary", "m_qm_timely_manner", "<", 80),
    Rule("qm_timely_manner_high_binary", "m_qm_timely_manner", ">", 97),
    Rule("qm_risk_fall_low_binary", "m_qm_risk_falling", "<", 90),
    Rule("qm_risk_fall_high_binary", "m_qm_risk_falling", ">", 99),
    Rule("qm_check_depression_low_binary", "m_qm_depression", "<", 85),
    Rule("qm_check_depression_high_binary", "m_qm_depression", ">", 95),
    Rule("qm_immun_shots_low_binary", "qm_immun_shots", "<", 60),
    Rule("qm_immun_shots_high_binary", "qm_immun_shots", ">", 80),
    Rule("qm_diab_care_low_binary", "m_qm_diabetes_footcare", "<", 80),
    Rule("qm_diab_care_high_binary", "m_qm_diabetes_footcare", ">=", 98),
    Rule("qm_diab_care_med_binary", "m_qm_diabetes_footcare", "between", (80, 97)),
    Rule("qm_func_status_avg_low_binary", "qm_func_status_avg", "<", 30),
    Rule("qm_func_status_avg_high_binary", "qm_func_status_avg", ">", 75),
    Rule("qm_func_status_avg_med_binary", "qm_func_status_avg", "between", (30, 50)),
    Rule("qm_improv_breathing_low_binary", "m_qm_breathing", "<", 50),
    Rule("qm_improv_breathing_high_binary", "m_qm_breathing", ">", 75),
    Rule("qm_improv_wounds_low_binary", "m_qm_improv_wounds", "<", 85),
    Rule("qm_improv_wounds_high_binary", "m_qm_improv_wounds", ">", 95),
    Rule("qm_correct_meds_low_binary", "m_qm_correct_meds", "<", 35),
    Rule("qm_correct_meds_high_binary", "m_qm_correct_meds", ">", 80),
    Rule("qm_correct_meds_med_binary", "m_qm_correct_meds", "between", (65, 80)),
    Rule("qm_urgent_care_low_binary", "m_qm_urgent_care_no_hosp", "<", 5),
    Rule("qm_urgent_care_high_binary", "m_qm_urgent_care_no_hosp", ">", 15),
    Rule("def_patient_rights_bin", "def_patient_rights", ">", 0),
    Rule("def_compliance_bin", "def_compliance", ">", 0),
    Rule("def_org_admin_bin", "def_org_admin", ">", 0),
    Rule("def_prof_personel_bin", "def_prof_personel", ">", 0),
    Rule("def_med_poc_bin", "def_med_poc", ">", 0),
    Rule("def_report_info_bin", "def_report_info", ">", 0),
    Rule("def_skilled_nurse_bin", "def_skilled_nurse", ">", 0),
    Rule("def_therapy_service_bin", "def_therapy_service", ">", 0),
    Rule("def_social_service_bin", "def_social_service", ">", 0),
    Rule("def_hha_service_bin", "def_hha_service", ">", 0),
    Rule("def_clinical_records_bin", "def_clinical_records", ">", 0),
    Rule("def_program_eval_bin", "def_program_eval", ">", 0),
    Rule("HC_prof_care_low_binary", "m_hcaps_prof_care", "<", 82),
    Rule("HC_prof_care_high_binary", "m_hcaps_prof_care", ">", 94),
    Rule("HC_good_comm_low_binary", "m_hcaps_communicated", "<", 78),
    Rule("HC_good_comm_high_binary", "m_hcaps_communicated", ">", 92),
    Rule("HC_dis_med_pain_saf_low_binary", "m_hcaps_discuss_med", "<", 75),
    Rule("HC_dis_med_pain_saf_high_binary", "m_hcaps_discuss_med", ">", 91),
    Rule("HC_hh_rate_over8_low_binary", "m_hcaps_above_8", "<", 75),
    Rule("HC_hh_rate_over8_high_binary", "m_hcaps_above_8", ">", 93),
    Rule("HC_def_rec_low_binary", "m_hcaps_definitely_recommend", "<", 68),
    Rule("HC_def_rec_high_binary", "m_hcaps_definitely_recommend", ">", 89),
]

# Admissions per year below which an outcome counts as small (fixed values).
SMALL_LIMITS = {
    "pred_all_small_flag": 10,
    "pred_med_other_small_flag": 15,
    "pred_surg_other_small_flag": 54,
    "pred_CHF_small_flag": 125,
    "pred_med_high_risk_small_flag": 33,
    "pred_med_low_risk_small_flag": 15,
    "pred_surg_high_risk_small_flag": 54,
    "pred_surg_low_risk_small_flag": 125,
    "pred_lung_small_flag": 83,
}

# Allegation code lists (fixed values).
SUBSTANTIATED = (1,)
QUALITY_OF_CARE = (11,)
ABUSE_NEGLECT = (1, 2, 3)
STAFFING = (15, 16, 17, 18, 19, 30)
REHOSPITALISATION = (1, 2, 3, 11, 15, 16, 17, 18, 19, 30)

# Weight of an allegation finding; any other finding weighs 0 (fixed values).
FINDING_WEIGHTS = {1: 2, 2: 1}
