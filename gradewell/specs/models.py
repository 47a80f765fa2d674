"""Fixed values of the nine outcome models.

Each outcome has a model for the worst and for the best result (intercept and
feature weights), the score-difference breaks of its 20 bins, the steps from
percentile to estimate and the base rates its estimates multiply.
"""

from __future__ import annotations

from typing import NamedTuple


class Model(NamedTuple):
    intercept: float
    betas: dict[str, float]


class Outcome(NamedTuple):
    worst: Model
    best: Model
    breaks: list[float]
    small_flag: str
    steps: list[tuple[float, float]]
    last_step: float
    percentile: str
    letter: str
    rates: str
    letter_base: float
    state_base: float


# Fixed values.
OUTCOMES: dict[str, Outcome] = {
    "all": Outcome(
        worst=Model(
            2.4127,
            {
                "m_qm_admit_hosp": 0.0525,
                "def_prof_personel": 0.4924,
                "m_hcaps_discuss_med": -0.0810,
                "rate_adj": 11.3188,
            },
        ),
        best=Model(
            1.0807,
            {
                "m_qm_admit_hosp": -0.0709,
                "def_total": -0.0734,
                "weight_flag": -0.1720,
                "qm_immun_shots_high_binary": 0.5896,
                "qm_diab_care_high_binary": 0.5068,
                "rate_adj": -7.4803,
            },
        ),
        breaks=[
            -0.2767, -0.2037, -0.1556, -0.1325, -0.1126, -0.0843, -0.0669,
            -0.0427, -0.0277, -0.0104, 0.0149, 0.0351, 0.0523, 0.0730,
            0.1007, 0.1319, 0.1745, 0.2385, 0.3127,
        ],
        small_flag="pred_all_small_flag",
        steps=[
            (5, 1.1239), (10, 1.1185), (15, 1.0937), (35, 1.0285),
            (60, 0.9997), (85, 0.9706), (90, 0.9082), (95, 0.8309),
        ],
        last_step=0.7234,
        percentile="pred_all_diff_ptile",
        letter="pred_all_diff_ptile_rank",
        rates="pred_all",
        letter_base=0.147237,
        state_base=0.147237,
    ),
    "med": Outcome(
        worst=Model(
            2.8018,
            {
                "m_qm_admit_hosp": 0.0579,
                "def_prof_personel": 0.5239,
                "staff_nutrit_fulltime_binary": -0.5639,
                "aide_over_tot_licensed": 0.2097,
                "qm_correct_meds_low_binary": 0.9480,
                "m_hcaps_discuss_med": -0.0619,
            },
        ),
        best=Model(
            -3.8765,
            {
                "m_qm_admit_hosp": -0.0955,
                "def_total": -0.0589,
                "qm_immun_shots_high_binary": 0.5094,
                "qm_improv_wounds_high_binary": 0.4842,
                "qm_urgent_care_low_binary": 3.1146,
                "m_hcaps_discuss_med": 0.0451,
            },
        ),
        breaks=[
            -0.2704, -0.2052, -0.1577, -0.1299, -0.0917, -0.0725, -0.0537,
            -0.0347, -0.0156, 0.0018, 0.0184, 0.0366, 0.0567, 0.0839,
            0.1067, 0.1355, 0.1837, 0.2317, 0.3278,
        ],
        small_flag="pred_med_other_small_flag",
        steps=[
            (5, 1.1216), (10, 1.0965), (15, 1.0511), (50, 1.0319),
            (75, 0.9677), (85, 0.9547), (90, 0.8849), (95, 0.8584),
        ],
        last_step=0.7188,
        percentile="pred_med_diff_ptile",
        letter="pred_med_diff_ptile_rank",
        rates="pred_med_other",
        letter_base=0.175482,
        state_base=0.175482,
    ),
    "surg": Outcome(
        worst=Model(
            2.0216,
            {
                "m_qm_admit_hosp": 0.0669,
                "no_hha_serv_binary": 2.5702,
                "qm_correct_meds_med_binary": 0.9438,
                "m_hcaps_definitely_recommend": -0.0562,
            },
        ),
        best=Model(
            -4.9862,
            {
                "m_qm_timely_manner": 0.0325,
                "survey_good_care_binary": 0.5786,
                "qm_immun_shots_high_binary": 0.4340,
                "qm_improv_wounds_high_binary": 0.4917,
                "qm_urgent_care_high_binary": 0.6795,
            },
        ),
        breaks=[
            -0.2145, -0.1581, -0.1080, -0.0861, -0.0702, -0.0521, -0.0386,
            -0.0245, -0.0143, -0.0021, 0.0107, 0.0293, 0.0456, 0.0632,
            0.0824, 0.1127, 0.1314, 0.1604, 0.2145,
        ],
        small_flag="pred_surg_other_small_flag",
        steps=[
            (5, 1.2346), (15, 1.1099), (20, 1.0235), (35, 1.0142),
            (40, 1.0060), (90, 0.9772), (95, 0.8264),
        ],
        last_step=0.7276,
        percentile="pred_surg_diff_ptile",
        letter="pred_surg_diff_ptile_rank",
        rates="pred_surg_other",
        letter_base=0.071103,
        state_base=0.071103,
    ),
    "chf": Outcome(
        worst=Model(
            -4.3468,
            {
                "m_qm_admit_hosp": 0.0579,
                "rate_adj": 11.0786,
            },
        ),
        best=Model(
            -0.0274,
            {
                "m_qm_admit_hosp": -0.0530,
                "alleg_binary": -0.9435,
                "def_med_poc_bin": -0.6635,
            },
        ),
        breaks=[
            -0.2212, -0.1571, -0.1268, -0.1039, -0.0845, -0.0695, -0.0652,
            -0.0461, -0.0273, -0.0085, 0.0100, 0.0283, 0.0456, 0.0646,
            0.0824, 0.1002, 0.1339, 0.1768, 0.2210,
        ],
        small_flag="pred_CHF_small_flag",
        steps=[
            (15, 1.1194), (25, 1.0585), (55, 0.9903), (80, 0.9596),
            (95, 0.9482),
        ],
        last_step=0.8265,
        percentile="pred_chf_diff_ptile",
        letter="pred_chf_diff_ptile_rank",
        rates="pred_CHF",
        letter_base=0.175482,
        state_base=0.175482,
    ),
    "med_high": Outcome(
        worst=Model(
            3.2519,
            {
                "m_qm_admit_hosp": 0.0938,
                "def_org_admin": 0.2065,
                "census_discharge_hosp_per_year": 0.000007907,
                "staff_ot_fulltime_binary": -0.6075,
                "qm_diab_care_high_binary": -0.7342,
                "m_hcaps_discuss_med": -0.0703,
            },
        ),
        best=Model(
            -0.1606,
            {
                "m_qm_admit_hosp": -0.1091,
                "qm_diab_care_high_binary": 0.8109,
                "qm_improv_wounds_high_binary": 0.7478,
            },
        ),
        breaks=[
            -0.3364, -0.2563, -0.1983, -0.1615, -0.1361, -0.1047, -0.0690,
            -0.0414, -0.0199, -0.0019, 0.0156, 0.0377, 0.0634, 0.1008,
            0.1361, 0.1710, 0.2105, 0.2758, 0.3952,
        ],
        small_flag="pred_med_high_risk_small_flag",
        steps=[
            (5, 1.1396), (15, 1.0689), (70, 1.0052), (85, 0.9152),
            (90, 0.8747), (95, 0.8254),
        ],
        last_step=0.7884,
        percentile="pred_med_high_risk_diff_ptile",
        letter="pred_med_high_diff_ptile_rank",
        rates="pred_med_high",
        letter_base=0.175482,
        state_base=0.175482,
    ),
    "med_low": Outcome(
        worst=Model(
            -1.2702,
            {
                "m_qm_correct_meds": -0.0256,
                "m_qm_admit_hosp": 0.0366,
                "for_profit_binary": 0.6124,
                "medicare_only_binary": 0.5877,
                "qm_diab_care_low_binary": 0.6276,
            },
        ),
        best=Model(
            -6.6563,
            {
                "m_qm_correct_meds": 0.0372,
                "m_qm_admit_hosp": -0.0702,
                "survey_good_care_binary": 0.3554,
                "m_hcaps_discuss_med": 0.0488,
            },
        ),
        breaks=[
            -0.2521, -0.1971, -0.1484, -0.1191, -0.0961, -0.0799, -0.0568,
            -0.0387, -0.0174, 0.0026, 0.0177, 0.0385, 0.0596, 0.0733,
            0.0948, 0.1258, 0.1635, 0.2066, 0.2577,
        ],
        small_flag="pred_med_low_risk_small_flag",
        steps=[
            (30, 1.0701), (45, 1.0456), (80, 0.9609), (85, 0.8865),
            (90, 0.8746), (95, 0.8658),
        ],
        last_step=0.7931,
        percentile="pred_med_low_risk_diff_ptile",
        letter="pred_med_low_diff_ptile_rank",
        rates="pred_med_low",
        letter_base=0.175482,
        state_base=0.175482,
    ),
    "surg_high": Outcome(
        worst=Model(
            2.3094,
            {
                "m_qm_admit_hosp": 0.0759,
                "staff_nutrit_fulltime_binary": -0.9539,
                "no_hha_serv_binary": 3.2871,
                "m_hcaps_definitely_recommend": -0.0596,
            },
        ),
        best=Model(
            -1.8662,
            {
                "survey_good_care_binary": 0.4770,
                "qm_diab_care_high_binary": 0.5348,
                "qm_improv_wounds_high_binary": 0.5991,
            },
        ),
        breaks=[
            -0.2430, -0.1488, -0.1081, -0.0867, -0.0694, -0.0469, -0.0300,
            -0.0157, 0.0026, 0.0162, 0.0295, 0.0443, 0.0593, 0.0743,
            0.0910, 0.1085, 0.1275, 0.1453, 0.1921,
        ],
        small_flag="pred_surg_high_risk_small_flag",
        steps=[
            (5, 1.2470), (10, 1.1841), (70, 1.0464), (95, 0.9019),
        ],
        last_step=0.7995,
        percentile="pred_surg_high_risk_diff_ptile",
        letter="pred_surg_high_risk_diff_ptile_rank",
        rates="pred_surg_high",
        letter_base=0.071103,
        state_base=0.071103,
    ),
    "surg_low": Outcome(
        worst=Model(
            0.4902,
            {
                "def_prof_personel": 0.7661,
                "def_report_info": 0.9542,
                "for_profit_binary": 0.7271,
                "staff_speech_fulltime_binary": -0.5405,
                "staff_nutrit_fulltime_binary": -0.7840,
                "no_hha_serv_binary": 3.0103,
                "qm_immun_shots": -0.0314,
                "qm_func_status_avg_med_binary": 2.6364,
            },
        ),
        best=Model(
            -0.4813,
            {
                "m_qm_admit_hosp": -0.0646,
            },
        ),
        breaks=[
            -0.2896, -0.1776, -0.1355, -0.1052, -0.0775, -0.0580, -0.0430,
            -0.0240, -0.0041, 0.0181, 0.0366, 0.0578, 0.0717, 0.0871,
            0.1046, 0.1309, 0.1575, 0.1837, 0.2146,
        ],
        small_flag="pred_surg_low_risk_small_flag",
        steps=[
            (5, 1.7016), (10, 1.1543), (25, 1.0696), (70, 1.0034),
            (90, 0.7357), (95, 0.5936),
        ],
        last_step=0.5594,
        percentile="pred_surg_low_risk_diff_ptile",
        letter="pred_surg_low_risk_diff_ptile_rank",
        rates="pred_surg_low",
        letter_base=0.071103,
        state_base=0.071103,
    ),
    "lung": Outcome(
        worst=Model(
            2.1279,
            {
                "m_qm_depression": -0.0530,
                "m_qm_admit_hosp": 0.0899,
                "def_org_admin": 0.3670,
            },
        ),
        best=Model(
            -0.8045,
            {
                "m_qm_admit_hosp": -0.0978,
                "medical_admin_binary": 0.7485,
                "qm_diab_care_high_binary": 0.7664,
                "qm_func_status_avg_high_binary": 1.4365,
            },
        ),
        breaks=[
            -0.3230, -0.2329, -0.1827, -0.1334, -0.1031, -0.0840, -0.0593,
            -0.0368, -0.0172, -0.0048, 0.0183, 0.0400, 0.0601, 0.0851,
            0.1057, 0.1433, 0.1774, 0.2265, 0.3355,
        ],
        small_flag="pred_lung_small_flag",
        steps=[
            (5, 1.1634), (15, 1.0664), (45, 1.0269), (85, 0.9256),
            (90, 0.8729), (95, 0.8539),
        ],
        last_step=0.7666,
        percentile="pred_lung_diff_ptile",
        letter="pred_lung_diff_ptile_rank",
        rates="pred_lung_diff",
        letter_base=0.071103,
        state_base=0.175482,
    ),
}
