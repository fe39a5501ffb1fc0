"""Names, spellings and patterns that results must share. Order is precedence."""

from __future__ import annotations

from tidemark.functions.text import FuzzyName, TextClass

CITY_NAMES = [
    FuzzyName("OLATHE", near=[("OLATHE", 2)], not_words=["PLATTE", "BLYTHE"], words=["66061", "66062", "OL"], like=["OLATHE"]),
    FuzzyName(
        "OVERLAND PARK",
        near=[("OVERLAND PARK", 4)],
        not_like=["^[RP]O[EW]{0,2}L(A|OA|AL)(N|M)D?", "(SUN ?LAND|OAKLAND|WOODLAND|ROLEAND|ORLAND PARK)"],
        words=["OVERLAND", "OV. PARK", "OVER", "OVERPARK", "OPKS", "OVLND PK"],
        like=[r"^(O|0)\.? ?P;?\.?$", r"^OV\.? ?P(AR)?K\.?$"],
    ),
    FuzzyName(
        "SHAWNEE",
        near=[("SHAWNEE", 3)],
        not_words=["SANTEE", "CHANGE", "OZAWKEE", "SHAWNEE MS", "PAWNEE", "HAWLEY", "SHAKOPEE", "SHINER"],
        like=["(66203|66217)"],
    ),
    FuzzyName("LENEXA", near=[("LENEXA", 2)], not_like=["(SENECA|GENEVA)"], words=["LENEXALENEXA", "LENEXA KANASAS", "LENEXA DR"], like=["66216"]),
    FuzzyName("KANSAS CITY", near=[("KANSAS CITY", 3)], not_words=["ARKANSAS CITY"]),
    FuzzyName("GARDNER", near=[("GARDNER", 1)], words=["66030", "GARNDER", "GARDNER LAKE"]),
    FuzzyName("BONNER SPRINGS", near=[("BONNER SPRINGS", 2)], words=["BONNER", "BONNOR SPIRNGS"], like=["BONNER SPGS"]),
    FuzzyName("DE SOTO", near=[("DE SOTO", 3)], not_words=["DENSON"], words=["66018"]),
    FuzzyName("EDGERTON", near=[("EDGERTON", 1)], words=["EDGERTON RD"]),
    FuzzyName("LEAWOOD", near=[("LEAWOOD", 1)], words=["LEAWODO", "LEE WOOD"]),
    FuzzyName("MERRIAM", near=[("MERRIAM", 2)], words=["MERRIAM WOODS"]),
    FuzzyName("MISSION", near=[("MISSION", 2)], like=[r"^MISSION\.*$"]),
    FuzzyName("MISSION HILLS", near=[("MISSION HILLS", 3)]),
    FuzzyName("MISSION WOODS", near=[("MISSION WOODS", 3)]),
    FuzzyName("PRAIRIE VILLAGE", near=[("PRAIRIE VILLAGE", 5)], words=["PRAIRIE", "PR.VILLAGE", "PRAIRE", "PRARIE VI"], like=[r"^P\.?V\.?$"]),
    FuzzyName("ROELAND PARK", near=[("ROELAND PARK", 2)], not_words=["OERLAND PARK", "ORLAND PARK"], words=["ROELAND", "ROEPARK"]),
    FuzzyName("SHAWNEE MISSION", near=[("SHAWNEE MISSION", 7)], words=["SM"]),
    FuzzyName("SPRING HILL", near=[("SPRING HILL", 2)], like=[r"^SPRING HILL \("]),
    FuzzyName("CLEARVIEW CITY", near=[("CLEARVIEW CITY", 4), ("CLEARVIEW", 2)]),
    FuzzyName("STILWELL", near=[("STILWELL", 2)]),
    FuzzyName("FAIRWAY", words=["FARIWAY", "FAIRYWAY", "MISSION HIGHLANDS"], like=["FAIRWAY"]),
    FuzzyName("LAKE QUIVIRA", near=[("LAKE QUIVIRA", 5)], not_like=["(BUTLER|ZURICK)"], like=["^LAKE QUIVIRA"]),
    FuzzyName("WESTWOOD", near=[("WESTWOOD", 1)]),
    FuzzyName("WESTWOOD HILLS", near=[("WESTWOOD HILLS", 1)]),
    FuzzyName("STANLEY", near=[("STANLEY", 2)], not_words=["STAPLES"]),
    FuzzyName("OXFORD", words=["OXFORD", "OXFORD KANSAS"]),
    FuzzyName("EUDORA", near=[("EUDORA", 1)], not_words=["ELDORA"], words=["EUODRA"]),
    FuzzyName("BUCYRUS", near=[("BUCYRUS", 3)], not_words=["BURNS"]),
    FuzzyName("NEW CENTURY", near=[("NEW CENTURY", 5)], not_words=["OAK CENTER"], like=["^NEW CENTURY"]),
]
CITY_NULLS = ["", "`", "."]

RESIDENT_TRACT_PREFIX = "20091"

PROGRAM_CLASSES = [
    TextClass("ACT", ["ACT"]),
    TextClass("YOUTH TREATMENT", ["ADOLESCENT", "YOUTH", "PEDIATRICS"]),
    TextClass("MENTAL HEALTH", ["MH", "MENTAL HEALTH"]),
    TextClass("FAMILY", ["FAMILY", "FAM FOCUS"]),
    TextClass("GAMBLING", ["GAMBLING"]),
    TextClass("EMPLOYMENT", ["EMPLOYMENT", "VOCATIONAL"]),
    TextClass("SUBSTANCE ABUSE", ["ALCOHOL", "DRUG", "SUBSTANCE ABUSE", "SUD", "DETOXIFICATION"]),
    TextClass("PRE-ADMIT", ["^PRE"], also=["ADMIT"]),
    TextClass("CSS", ["CSS"]),
    TextClass("CDS", ["CDS"]),
]

DISCHARGE_CLASSES = [
    TextClass("DEATH", ["^DEATH"]),
    TextClass("FURTHER CARE NOT AVAILABLE", ["^FURTHER CARE NOT AVAILABLE"]),
    TextClass("MUTUAL DECISION", ["^MUTUAL DECISION"]),
    TextClass("TREATMENT NOT COMPLETE: AGENCY DECISION", ["NOT COMPLETE"], also=["AGCY DECISION", "AGENCY DECISION"]),
    TextClass("TREATMENT NOT COMPLETE: CLIENT DECISION", ["NOT COMPLETE"], also=["CLIENT DECISION"], or_any=["DROPPED OUT"]),
    TextClass("COMPLETED", ["TREATMENT COMPLETE", "EVALUATION COMPLETE"]),
    TextClass("PRE-ADMIT: CLIENT ADMITTED", ["PRE"], also=["ADMITTED"]),
    TextClass("CLIENT MOVED", ["CLIENT MOVED"]),
    TextClass("TRANSFER", ["^TRANSFER"]),
    TextClass("TREATMENT REJECTED", ["TREATMENT REJECTED", "REFUSED"]),
    TextClass("TREATMENT CANCELLED", ["CANCELLED|CANCELED", "NO SHOW"]),
]

_USE = ["(RELATE|USE|INDUCE|INTOX|WITHD)", r"(DEPENDENCE|PERCEPT|DEP\.)"]
DIAGNOSIS_CLASSES = [
    TextClass("NEURODEVELOPMENTAL", ["(INTELLECTUAL DIS|AUTIS|ASPERGER)", "ATT(ENTIO)?N( |-)DEFI?CI?T", "(DEVELOPM|LANGUAGE|TOURETTE)", "( TIC |RETARD|FETAL ALC)", "^(TIC)"]),
    TextClass(
        "PSYCHOTIC",
        ["(SCHIZ|DELUSION|PSYCHOTIC|CATATON)", "PSYCHOS(I|E)S"],
        none_of=["DEMENTIA", "^(BIPOLAR|MAJOR DEP|CANNABIS)", "^(MANIC|OPIOID|OTH STIM)", "^OTHER (PSYCHOACTI|STIMULA)", "NONPSYCHOTIC"],
    ),
    TextClass("BIPOLAR", ["(BIPOLAR|CYCLOTHYM|MANIC D|MANIC E)"]),
    TextClass("DEPRESSIVE", ["(DISRUPTIVE MOOD|DEPRESS|DYSTHYM)"], none_of=["^ADJUSTMENT", "DEMENTIA"], or_any=["PREMENSTRUAL"]),
    TextClass("ANXIETY", ["(ANXIETY|PHOBIA|PANIC)"], none_of=["^(ADJUST|ALCOH|CANNAB|HALLUC)"]),
    TextClass("OBSESSIVE-COMPULSIVE", ["(OBSESSIVE|DYSMORPHIC|HOARDING)", "(TRICHOTILLO|EXCORIATION)"]),
    TextClass(
        "TRAUMA- OR STRESSOR- RELATED",
        ["(REACTIVE ATTACH|DISINHIB|STRESS)", "(ADJUSTMENT|TRAUMA)"],
        unless_all=["(SHOULDER|AMPUTATIO|BIRTH|BRAIN)", "(SUBDURAL)"],
    ),
    TextClass("DISSOCIATIVE", ["(DISS?OCIA|DEPERSONAL|DEREALIZ)", "MULTIPLE PERSONALITY"]),
    TextClass("SOMATIC SYMPTOM", ["(SOMATIC|ILLNESS A|CONVERSION)", "(FACTITIOUS|SOMATOFORM)"]),
    TextClass("FEEDING OR EATING", ["(PICA|RUMINATION|FOOD|ANOREXIA)", "(BULIMIA|BINGE|FEEDING|EATING)"], none_of=["ALLERGY"]),
    TextClass("ELIMINATION", ["(ENURESIS|ENCOPRESIS|ELIMINATION)"]),
    TextClass("SLEEP-WAKE", ["(SOMN|NARCOL|SLEEP|NIGHTM|RESTLESS)"]),
    TextClass("GENDER DYSPHORIA", ["(GENDER|PSYCHOSEXUAL IDENTITY)", "SEX REASSIGN"]),
    TextClass("DISRUPTIVE, IMPULSE-CONTROL, AND CODUCT", ["(OPPOSITION|EXPLO|CONDUCT|ANTISOC)", "(PYRO|KLEPTO|IMPULSE)"]),
    TextClass("NEUROCOGNITIVE", ["(NEUROCOG|DELIRIUM|ALZH|DEMENTI)", "COGNITIVE DECLINE"], none_of=["^(ALCOHOL|OPIOID|OTHER STIMULA)"]),
    TextClass("PERSONALITY", ["PERSONALITY", "^PARANOIA$"]),
    TextClass("PARAPHILIC", ["(VOYUER|EXHIBI|FROTT|MASOCH|SADISM)", "(PEDOPH|FETISH|TRANSV|PARAPHILIC)"]),
    TextClass(
        "SUBSTANCE-RELATED OR ADDICTIVE",
        ["(SUBSTANCE|ALCOHOL)", "(CANNAB|HALLUC|PHENCY|INHAL)", "(OPIOID|SEDATIVE|STIMULANT)", "(COCAINE|DRUG)", "(NICOTINE)", "(AMPHETAMI)"],
        also=_USE,
        or_any=["^AMPHET"],
    ),
    TextClass("OTHER SUBSTANCE-RELATED OR ADDICTIVE", ["(CAFFEINE)", "(TOBACCO)"], also=_USE, or_any=["GAMBLING"]),
    TextClass("SUICIDE IDEATION OR SELF-HARM", ["(SELF-HARM|SUIC)"]),
    TextClass(
        "ABUSE OR NEGLECT",
        [
            "(PHYSICAL ABUSE|SEXUAL ABUSE|PSYCHOLOGICAL ABUSE|EMOTIONAL ABUSE|CHILD ABUSE|PARTNER ABUSE)",
            "(NEGLECT|MALTREATMENT|ABANDONMENT)",
            "(ABUSE IN CHILDHOOD|ABUSE OF ADULT)",
        ],
    ),
    TextClass(
        "OTHER FAMILY",
        [
            "(DISAPPEARANCE OF FAMILY MEMBER|DEATH OF FAMILY MEMBER)",
            "(CHILDHOOD EMOTIONAL DISORDER|CHILD CONFLICT)",
            "(PARENT-CHILD|PARENT-FOSTER|PARENT-BIOLOGICAL CHILD CONFLICT|SIBLING RIVALRY|SIBLING RELATIONAL PROBLEM)",
            "(PARTNER RELATIONAL PROBLEM|RELATIONSHIP WITH SPOUSE OR PARTNER|RELATIONAL PROBLEM)",
        ],
    ),
    TextClass(
        "HOUSING OR ECONOMIC",
        [
            "(HOMELESS|HOUSING|RESIDENTIAL INST|LODGER|LANDLORD|LIVING ALONE)",
            "(LOW INCOME|OCCUPATION|ECONOMIC|UNEMPLOY)",
            "(SOCIAL INS|WELFARE SUP)",
        ],
    ),
    TextClass("CRIMINAL", ["(PRISON|CRIMINAL)"]),
    TextClass("ASSAULT", ["(ASSAULT)"]),
    TextClass("OTHER SOCIAL", ["(SOCIAL EXCL|REJECTION|SUPPORT GROUP|SOCIAL ENV)", "RELIGIOUS OR SPIRITUAL PROBLEM", "SELF-ESTEEM"]),
    TextClass("OTHER MENTAL DISORDER", ["(BEHAVIOURAL DISORDER|MENTAL DISORDER|MOOD DISORDER|EMOTIONAL DISORDER)"]),
]

MENTAL_CRISIS_CLASSES = ["PSYCHOTIC", "BIPOLAR", "DEPRESSIVE", "ANXIETY", "OBSESSIVE-COMPULSIVE", "TRAUMA- OR STRESSOR- RELATED"]

# LIKE patterns of call reports: by impression (two columns) and complaint.
SUICIDAL_ANYWHERE = ["%sui_id%"]
SUICIDAL_COMPLAINT = ["%kill%self%", "%self%harm%", "%i %want% die%", "%i %don% want% live%", "%cut%wrists%"]
SUICIDAL_VETO = ["%don%want%die%"]
SUICIDAL_PAIR = ("%psych%", "%end%life%")
ATTEMPT_IMPRESSION = ["suicide attempt"]
DRUG_ANYWHERE = ["%subst%abuse%", "%overdose%", "%ETOH%", "%alcohol%"]
DRUG_COMPLAINT = ["% meth", "meth %", "% meth %", "% meth.%", "% heroin%"]
DRUG_ABUSE = ["%drug abuse%"]
DRUG_ABUSE_VETO = ["%laundry%", "%detergent%", "%tide%"]
MENTAL_ANYWHERE = ["%psych%", "%anxiety%", "%depress%"]
ALCOHOL_ANYWHERE = ["%alcohol%", "%ETOH%"]
INGEST_ANYWHERE = ["%drug%ingest%"]
INGEST_VETO = ["%allerg%"]

# LIKE patterns of hospital diagnoses (primary and secondary column alike unless said).
VISIT_ATTEMPT = ["suicide attempt%"]
VISIT_SUICIDAL = ["suicide attempt%", "nonsuicidal self-harm%", "suic%ideation%", "%self%harm%"]
VISIT_SUICIDAL_SECONDARY = ["PERSONAL HISTORY OF SUICIDAL BEHAVIOR"]
VISIT_DRUG = [
    "%poisoning%self%harm%", "%toxic%self%harm%", "%cocaine%", "%fentanyl%", "%opioid%", "%amphetam%",
    "%substance abuse%", "%alcohol %", "%withdrawal%", "%toxic%ethanol%",
]
VISIT_ALCOHOL = ["%alcohol %", "%toxic%ethanol%"]
VISIT_POISONING = ["%poisoning by%"]

# Exit causes.
OVERDOSE_CAUSE = ["%overdose%", "%into%", "%fentanyl%"]
SUICIDE_MANNER = ["%sui%"]

# Priority of date columns when a table's event date is found by column name.
EVENT_DATE_ORDER = [
    "columbia_assessment_date", "assesment_date", "call_date", "data_entry_date", "effect_date", "dschg_date", "svc_date", "status_date",
]
