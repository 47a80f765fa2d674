"""Deficiency tag lists."""

# Fixed values.
TAG_LISTS: dict[str, list[str]] = {
    "def_patient_rights": [
        "G-0100", "G-0101", "G-0102", "G-0103", "G-0104", "G-0105", "G-0106", "G-0107",
        "G-0108", "G-0109", "G-0110", "G-0111", "G-0112", "G-0113", "G-0114", "G-0115",
        "G-0116",
    ],
    "def_compliance": [
        "G-0117", "G-0118", "G-0119", "G-0120", "G-0121",
    ],
    "def_org_admin": [
        "G-0122", "G-0123", "G-0124", "G-0125", "G-0126", "G-0127", "G-0128", "G-0129",
        "G-0130", "G-0131", "G-0132", "G-0133", "G-0134", "G-0135", "G-0136", "G-0137",
        "G-0138", "G-0139", "G-0140", "G-0141", "G-0142", "G-0143", "G-0144", "G-0145",
        "G-0146", "G-0147", "G-0148", "G-0149", "G-0150",
    ],
    "def_prof_personel": [
        "G-0151", "G-0152", "G-0153", "G-0154", "G-0155",
    ],
    "def_med_poc": [
        "G-0156", "G-0157", "G-0158", "G-0159", "G-0160", "G-0161", "G-0162", "G-0163",
        "G-0164", "G-0165", "G-0166", "G-0300",
    ],
    "def_report_info": [
        "G-0320", "G-0321", "G-0322", "G-0324", "G-0325", "G-0326", "G-0327", "G-0328",
    ],
    "def_skilled_nurse": [
        "G-0168", "G-0169", "G-0170", "G-0171", "G-0172", "G-0173", "G-0174", "G-0175",
        "G-0176", "G-0177", "G-0178", "G-0179", "G-0180", "G-0181", "G-0182", "G-0183",
    ],
    "def_therapy_service": [
        "G-0184", "G-0185", "G-0186", "G-0187", "G-0188", "G-0189", "G-0190", "G-0191",
        "G-0192", "G-0193",
    ],
    "def_social_service": [
        "G-0194", "G-0195", "G-0196", "G-0197", "G-0198", "G-0199", "G-0200", "G-0201",
    ],
    "def_hha_service": [
        "G-0202", "G-0203", "G-0204", "G-0205", "G-0206", "G-0207", "G-0208", "G-0209",
        "G-0210", "G-0211", "G-0212", "G-0213", "G-0214", "G-0215", "G-0216", "G-0217",
        "G-0218", "G-0219", "G-0220", "G-0221", "G-0222", "G-0223", "G-0224", "G-0225",
        "G-0226", "G-0227", "G-0228", "G-0229", "G-0230", "G-0231", "G-0232", "G-0233",
        "G-0301", "G-0302",
    ],
    "def_clinical_records": [
        "G-0235", "G-0236", "G-0237", "G-0238", "G-0239", "G-0240", "G-0241", "G-0303",
    ],
    "def_program_eval": [
        "G-0242", "G-0243", "G-0244", "G-0245", "G-0246", "G-0247", "G-0248", "G-0249",
        "G-0250", "G-0251",
    ],
    "def_comp_assess": [
        "G-0330", "G-0331", "G-0332", "G-0333", "G-0334", "G-0335", "G-0336", "G-0337",
        "G-0338", "G-0339", "G-0340", "G-0341", "G-0342",
    ],
}
