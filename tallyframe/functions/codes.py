"""Category codes and the labels they stand for, one table per output column."""

# ---------------------------------------------------------------------------
# Raw code -> published label.
# ---------------------------------------------------------------------------

SEX = {
    "M": "Boys",
    "Male": "Boys",
    "1": "Boys",
    "F": "Girls",
    "Female": "Girls",
    "2": "Girls",
    "T": "Total",
    "0": "Total",
}

ESTABLISHMENT_TYPE_GROUP = {
    "ALL_STATE": "All state funded",
    "ALL": "All state funded",
    "AC": "Academy converter",
    "ACADEMY_CONV": "Academy converter",
    "AS": "Academy sponsor led",
    "ACADEMY_SPONS": "Academy sponsor led",
    "AC_FS": "Academies and free schools",
    "FS": "Free schools",
    "FREE_SCHOOL": "Free schools",
    "LA": "Local authority maintained",
    "LA_MAINT": "Local authority maintained",
    "AP": "Alternative provision",
    "ALT_PROV": "Alternative provision",
    "SS": "State funded special schools",
    "SPEC": "State funded special schools",
    "MST": "State funded mainstream schools",
    "STATE_AP": "State-funded schools and alternative provision",
}

ETHNICITY_MAJOR = {
    "WHITE": "White",
    "W": "White",
    "MIXED": "Mixed / Multiple ethnic groups",
    "MIX": "Mixed / Multiple ethnic groups",
    "ASIAN": "Asian / Asian British",
    "A": "Asian / Asian British",
    "BLACK": "Black / African / Caribbean / Black British",
    "B": "Black / African / Caribbean / Black British",
    "OTHER": "Other ethnic group",
    "O": "Other ethnic group",
    "UNKNOWN": "Unknown",
    "UNK": "Unknown",
    "NOBT": "Unknown",
    "REFU": "Unknown",
    "T": "Total",
    "TOTAL": "Total",
}

ETHNICITY_MINOR = {
    "WBRI": "English / Welsh / Scottish / Northern Irish / British",
    "WIRI": "Irish",
    "WIRT": "Irish Traveller",
    "WROM": "Gypsy",
    "WOTW": "Any other White background",
    "WOTH": "Any other White background",
    "MWBC": "White and Black Caribbean",
    "MWBA": "White and Black African",
    "MWAS": "White and Asian",
    "MOTH": "Any other Mixed / Multiple ethnic background",
    "MFIL": "Any other Mixed / Multiple ethnic background",
    "AIND": "Indian",
    "APKN": "Pakistani",
    "ABAN": "Bangladeshi",
    "ACHN": "Chinese",
    "AOTH": "Any other Asian background",
    "BCRB": "Caribbean",
    "BAFR": "African",
    "BOTH": "Any other Black / African / Caribbean background",
    "OOEG": "Any other ethnic group",
    "NOBT": "Unknown",
    "REFU": "Unknown",
    "UNK": "Unknown",
    "ALL_W": "All White",
    "ALL_M": "All Mixed / Multiple ethnic groups",
    "ALL_A": "All Asian / Asian British",
    "ALL_B": "All Black / African / Caribbean / Black British",
    "T": "Total",
    "TOTAL": "Total",
}

FIRST_LANGUAGE = {
    "ENG": "Known or believed to be English",
    "E": "Known or believed to be English",
    "OTH": "Known or believed to be other than English",
    "O": "Known or believed to be other than English",
    "UNK": "First language unknown",
    "U": "First language unknown",
    "T": "Total",
    "TOTAL": "Total",
}

MONTH_OF_BIRTH = {
    "1": "January",
    "01": "January",
    "2": "February",
    "02": "February",
    "3": "March",
    "03": "March",
    "4": "April",
    "04": "April",
    "5": "May",
    "05": "May",
    "6": "June",
    "06": "June",
    "7": "July",
    "07": "July",
    "8": "August",
    "08": "August",
    "9": "September",
    "09": "September",
    "10": "October",
    "11": "November",
    "12": "December",
    "T": "Total",
    "TOTAL": "Total",
}

SEN_PROVISION = {
    "E": "Education, health and care plan",
    "EHC": "Education, health and care plan",
    "K": "SEN support / SEN without an EHC plan",
    "SEN_SUPPORT": "SEN support / SEN without an EHC plan",
    "N": "No SEN provision",
    "NONE": "No SEN provision",
    "ALL_SEN": "All SEN provision",
    "A": "All SEN provision",
    "UNK": "Unknown SEN provision",
    "U": "Unknown SEN provision",
    "T": "Total",
    "TOTAL": "Total",
}

SEN_PRIMARY_NEED = {
    "AUT": "Autistic spectrum disorder",
    "SEMH": "Social, emotional and mental health",
    "BESD": "Social, emotional and mental health",
    "HI": "Hearing impairment",
    "MLD": "Moderate learning difficulty",
    "MSI": "Multi-sensory impairment",
    "OTH": "Other difficulty or disability",
    "PD": "Physical disability",
    "PMLD": "Profound and multiple learning difficulty",
    "SLCN": "Speech, language and communication needs",
    "SLD": "Severe learning difficulty",
    "SPLD": "Specific learning difficulty",
    "VI": "Vision impairment",
    "DYNA": "Down syndrome",
    "NSA": "SEN support but no specialist assessment of type of need",
    "T": "Total",
    "TOTAL": "Total",
}

EDUCATION_PHASE = {
    "PRI": "Highest statutory age 7",
    "PRIMARY": "Highest statutory age 7",
    "JUN": "Highest statutory age 8 to 11",
    "JUNIOR": "Highest statutory age 8 to 11",
    "MID": "Highest statutory age 8 to 11",
    "SEC": "Highest statutory age greater than 11",
    "SECONDARY": "Highest statutory age greater than 11",
    "ALL_THROUGH": "Highest statutory age greater than 11",
    "T": "Total",
    "TOTAL": "Total",
}

SCHOOL_RELIGIOUS_CHARACTER = {
    "CE": "Church of England",
    "COE": "Church of England",
    "RC": "Roman Catholic",
    "ROM_CATH": "Roman Catholic",
    "JEW": "Jewish",
    "JEWISH": "Jewish",
    "METH": "Methodist",
    "METHODIST": "Methodist",
    "MUS": "Muslim",
    "MUSLIM": "Muslim",
    "SIKH": "Sikh",
    "OTH_XIAN": "Other Christian faith",
    "OTHER_CHRISTIAN": "Other Christian faith",
    "OTH_REL": "Other religious character",
    "OTHER_RELIGIOUS": "Other religious character",
    "NONE": "No religious character",
    "NO_RELI": "No religious character",
    "T": "Total",
    "TOTAL": "Total",
}

DISADVANTAGE_STATUS = {
    "1": "Disadvantaged",
    "Y": "Disadvantaged",
    "True": "Disadvantaged",
    "Disadvantaged": "Disadvantaged",
    "0": "Not known to be disadvantaged",
    "N": "Not known to be disadvantaged",
    "False": "Not known to be disadvantaged",
    "T": "Total",
    "TOTAL": "Total",
}

FSM_STATUS = {
    "1": "FSM eligible",
    "Y": "FSM eligible",
    "True": "FSM eligible",
    "0": "Not known to be FSM eligible",
    "N": "Not known to be FSM eligible",
    "False": "Not known to be FSM eligible",
    "T": "Total",
    "TOTAL": "Total",
}

GEOGRAPHIC_LEVEL = {
    "NAT": "National",
    "NATIONAL": "National",
    "REG": "Regional",
    "REGIONAL": "Regional",
    "LA": "Local authority",
    "LOCAL_AUTH": "Local authority",
    "LOCAL_AUTHORITY": "Local authority",
}

COMPLETION_STATUS = {
    "C": "Completed",
    "A": "Absent",
    "U": "Unable to participate",
    "W": "Working below standard",
    "J": "Just arrived in England",
    "M": "Missing reason",
}

# Further codes, accepted by default beside the ones above.
FURTHER_CODES = {
    "sex": {"Total": "Total"},
    "ethnicity_minor": {
        "AAFR": "Any other Asian background",
        "CHNE": "Chinese",
    },
    "establishment_type_group": {
        "ACADEMIES_FREE": "Academies and free schools",
        "MAINSTREAM": "State funded mainstream schools",
        "STATE_AND_AP": "State-funded schools and alternative provision",
    },
}

# ---------------------------------------------------------------------------
# End of the fixed values.
# ---------------------------------------------------------------------------

#: Output column -> its codes.
BASE_CODES: dict[str, dict[str, str]] = {
    "sex": SEX,
    "ethnicity_major": ETHNICITY_MAJOR,
    "ethnicity_minor": ETHNICITY_MINOR,
    "first_language": FIRST_LANGUAGE,
    "fsm_status": FSM_STATUS,
    "disadvantage_status": DISADVANTAGE_STATUS,
    "month_of_birth": MONTH_OF_BIRTH,
    "sen_provision": SEN_PROVISION,
    "sen_primary_need": SEN_PRIMARY_NEED,
    "establishment_type_group": ESTABLISHMENT_TYPE_GROUP,
    "education_phase": EDUCATION_PHASE,
    "school_religious_character": SCHOOL_RELIGIOUS_CHARACTER,
    "geographic_level": GEOGRAPHIC_LEVEL,
}

STANDARD_CODES: dict[str, dict[str, str]] = {
    column: codes | FURTHER_CODES.get(column, {}) for column, codes in BASE_CODES.items()
}

#: Columns whose unknown and NULL codes become a fixed label; all others keep the raw value.
DEFAULT_LABELS: dict[str, str] = {"sex": "Total"}
