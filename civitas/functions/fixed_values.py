"""Phrases and patterns that results depend on. Each is a default that callers can replace."""

# ruff: noqa: E501

REASONS = (
    "will not make",
    "will not propose",
    "decided not to",
    "no legislative proposal",
    "neither scientific nor legal grounds",
    "existing legislation",
    "existing funding framework",
    "already covered",
    "no repeal",
    "differs from",
    "not to submit",
    "fall outside",
    "outside of eu competence",
    "outside the eu competence",
    "not within eu competence",
    "beyond eu competence",
    "interfere with",
)

DEADLINES = (
    r"committed to come forward with a legislative proposal[,\s]+by\s+([^.,;]+)",
    r"intention to table a legislative proposal[,\s]+by\s+([^.,;]+)",
    r"communicated its intention to table a legislative proposal[,\s]+by\s+([^.,;]+)",
    r"to table a legislative proposal[,\s]+by\s+([^.,;]+)",
    r"will table a legislative proposal[,\s]+by\s+([^.,;]+)",
    r"to propose legislation[,\s]+by\s+([^.,;]+)",
    r"will (?:then )?communicate[,\s]+by\s+([^.,;]+)",
    r"committed to communicate[,\s]+by\s+([^.,;]+)",
    r"will then communicate[,\s]+by\s+([^.,;]+)",
    r"consultation.*?(?:which )?will run until\s+([^.,;]+)",
    r"consultation.*?(?:runs|run).*?until\s+([^.,;]+)",
    r"call for evidence\s?(?:runs|run).*?until\s+([^.,;]+?)(?:\s+and|\s+or|$)",
    r"(?:call|consultation|initiative).*?(?:will run|runs|running).*?until\s+([^.,;]+)",
    r"launch.*?(?:impact )?assessment[,\s]+by\s+([^.,;]+)",
    r"conduct.*?study[,\s]+by\s+([^.,;]+)",
    r"carry out.*?(?:assessment|study)[,\s]+by\s+([^.,;]+)",
    r"scientific opinion[,\s]+by\s+([^.,;]+)",
    r"efsa.*?(?:to )?provide.*?(?:opinion|assessment)[,\s]+by\s+([^.,;]+)",
    r"complete.*?(?:assessment|study|evaluation)[,\s]+by\s+([^.,;]+)",
    r"external study to be carried out.*?by\s+([^.,;]+)",
    r"roadmap.*?(?:is planned|planned|completed?)[,\s]+by\s+([^.,;]+)",
    r"finalisation.*?roadmap.*?by\s+([^.,;]+)",
    r"work on.*?roadmap.*?by\s+([^.,;]+)",
    r"provide.*?report[,\s]+by\s+([^.,;]+)",
    r"provide.*?(?:update|information|data|details)[,\s]+by\s+([^.,;]+)",
    r"will report[,\s]+by\s+([^.,;]+)",
    r"(?:produce|publish).*?report[,\s]+by\s+([^.,;]+)",
    r"report.*?to be produced.*?(?:by|in)\s+([^.,;]+)",
    r"to\s+be\s+produced\s+in\s+([^.,;]+)",
    r"preparatory work.*?(?:with a view to )?launch.*?by\s+([^.,;]+)",
    r"call for evidence.*?by\s+([^.,;]+)",
    r"by\s+([^.,;]+),\s+provide.*?(?:information|data|details)",
    r"by\s+([^.,;]+),\s+the\s+commission\s+will\s+(?:communicate|report|provide)",
    r"by\s+([^.,;]+),\s+(?:to\s+)?(?:phase\s+out|ban|prohibit|implement)",
)

APPLICABLE = (
    "became applicable",
    "became applicable immediately",
    "and applicable from",
)

ADOPTED = (
    "council of the eu adopted",
    "council adopted the regulation",
    "published in the official journal",
    "following the agreement of the european parliament",
    "regulation adopted on",
    "directive adopted on",
    "was adopted by the commission",
    "implementing regulation adopted",
)

COMMITTED = (
    "committed to come forward with a legislative proposal",
    "communicated its intention to table a legislative proposal",
    "intention to table a legislative proposal",
    "will table a legislative proposal",
    "committed to table a legislative proposal",
    "to table a legislative proposal",
    "sets out plans for a legislative proposal",
    "will present proposals",
    "commitment to phase out",
    "plans for a legislative proposal",
)

REFUSED = (
    "will not make a legislative proposal",
    "not propose new legislation",
    "decided not to submit a legislative proposal",
    "has decided not to submit a legislative proposal",
    "no further legal acts are proposed",
    "no new legislation will be proposed",
    "no legislative proposal",
    "neither scientific nor legal grounds",
    "already covered",
    "proposals fall outside",
    "outside of eu competence",
    "outside the eu competence",
    "not within eu competence",
    "beyond eu competence",
)

NO_REPEAL = (
    "no repeal",
    "was proposed",
)

EXISTING = (
    "existing funding framework",
    "existing legislation",
    "already covered",
    "already in place",
    "legislation and policies already in place",
    "recently debated and agreed",
    "is the appropriate one",
    "policies already in place",
)

OTHER_ACTIONS = (
    "committed",
    "will continue",
    "monitor",
    "support",
)

ASSESSING = (
    "launch",
    "started working on",
    "external study to be carried out",
    "call for evidence",
    "preparatory work",
    "with a view to launch",
    "launched a review",
    "will communicate, by",
    "will communicate on",
)

ROADMAP = (
    "develop",
    "work on",
    "work together",
    "work with",
    "launched",
    "started work",
    "will work",
    "working on",
    "preparing",
    "towards",
)

MEASURES = (
    "committed, in particular, to taking the following actions",
    "launch an eu-wide public consultation",
    "improve transparency",
    "establish harmonised",
)

FOCUS = (
    "intends to focus on",
    "implementation of",
)

PROMISED = (
    "will propose",
    "committed to propose",
    "intention to table a legislative proposal",
    "will table a legislative proposal",
)

POLICY_TYPES = {
    "Impact Assessment and Consultation": (
        r"\bimpact assessments?\b",
        r"\bpublic consultations?\b",
        r"\bcalls? for evidence\b",
        r"\bconsultations? on\b",
    ),
    "Scientific Activity": (
        r"\bscientific conferences?\b",
        r"\bscientific opinions?\b",
        r"\befsa\b",
        r"\bworkshops?\b",
        r"\bcolloquia\b",
        r"\bcolloquiums?\b",
    ),
    "Policy Roadmap and Strategy": (
        r"\broadmaps?\b",
        r"\bstrategic plans?\b",
        r"\bstrengthened\b",
        r"\bmodernised\b",
        r"\benhanced\b",
        r"\bpolicy frameworks?\b",
        r"\blong-term strateg(?:y|ies)\b",
        r"\bmechanisms? in place\b",
        r"\bvisions? for\b",
        r"\bstrategic agendas?\b",
        r"\bpolicy priorities\b",
        r"\bmilestones?\b",
        r"\baction plans?\b",
    ),
    "Data Collection and Transparency": (
        r"\bdata collection\b",
        r"\btransparency\b",
        r"\bbenchmarking\b",
        r"\beurobarometers?\b",
        r"\bcollected factual information\b",
        r"\bdata on\b",
        r"\breports? (?:was|were) published\b",
        r"\bpublications?\b",
    ),
    "Stakeholder Dialogue": (
        r"\bstakeholders?\b",
        r"\bstakeholder partnerships?\b",
        r"\bstakeholder dialogues?\b",
        r"\bpartnerships? with stakeholders\b",
        r"\bpublic consultations?\b",
    ),
    "Monitoring and Enforcement": (
        r"\bmonitoring\b",
        r"\bmonitor\b",
        r"\bactive monitoring\b",
        r"\bwill monitor\b",
        r"\bbetter enforce\b",
        r"\bstrengthen enforcement\b",
        r"\benforcement\b",
        r"\bensure compliance\b",
        r"\bensuring compliance\b",
        r"\bcompliance\b",
        r"\bsupport member states\b",
        r"\bguarantee equal treatment\b",
        r"\bwithhold payments?\b",
        r"\bconditional funding\b",
        r"\bwithhold the corresponding payments?\b",
    ),
    "Funding Programme": (
        r"\bfunding\b",
        r"\bfinancial support\b",
        r"\bfinancial incentives?\b",
        r"\bsubsidies\b",
        r"\bhorizon europe\b",
        r"\berasmus\b",
        r"\bcreative europe\b",
        r"\bcohesion policy\b",
        r"\bcohesion policies\b",
        r"\bcohesion funding\b",
        r"\bunion funding\b",
        r"\bmultiannual financial frameworks?\b",
        r"\bmff\b",
        r"\bresearch and innovation\b",
        r"\bresearch projects?\b",
        r"\bpilot projects?\b",
    ),
    "Policy Implementation": (
        r"\bwill continue\b",
        r"\bcontinue to\b",
        r"\bensure\b",
        r"\bensuring\b",
        r"\bguarantee\b",
        r"\bmaintain\b",
        r"\bmaintaining\b",
        r"\bnon-discriminatory access\b",
        r"\bequal access\b",
        r"\bimplementation\b",
        r"\bimplementing\b",
        r"\bsafeguard\b",
        r"\bsets? of benchmarks?\b",
        r"\bcollect evidence on the current regulations?\b",
    ),
    "International Cooperation": (
        r"\binternational cooperation\b",
        r"\breaching out\b",
        r"\binternational partners?\b",
        r"\binternational levels?\b",
        r"\binternational fora\b",
        r"\binternational forums?\b",
        r"\binternational commissions?\b",
        r"\bun general assembly\b",
        r"\bICCAT\b",
        r"\bbest practices? between Member States\b",
        r"\bSustainable Development Goals EU\b",
        r"\bEU-wide public consultations?\b",
        r"\badvocating universal access\b",
    ),
}

LEGISLATIVE = {
    "law_active": (
        r"(?<!will\s)(?:became applicable|applies from|apply from|rules apply from)",
    ),
    "in_vacatio_legis": (
        r"(?<!will\s)(?:entered into force|came into force)(?!.*(?:became applicable|applies from|apply from))",
    ),
    "withdrawn": (
        r"(?:withdrawn|withdraw|withdrew)(?:(?!\bnot\b).)*?(?:proposal|regulation|directive|law|amendment|legislation)",
        r"(?:proposal|regulation|directive|law|amendment|legislation)(?:(?!\bnot\b).)*?(?:was |were )?(?:withdrawn|withdraw|withdrew)",
    ),
    "adopted": (
        r"(?:regulation|directive|law|amendment|legislation)(?:(?!\bnot\b).)*?(?:was |were )?(?:adopted|approved)",
        r"(?=adopted|approved)(?<!vision\s)(?<!strategy\s)(?<!communication\s)(?<!roadmap\s)(?<!plan\s)(?<!framework\s)(?<!programme\s)(?<!program\s)(?<!initiative\s)(?<!agenda\s)(?<!approach\s)(?<!guideline\s)(?<!guidelines\s)(?<!report\s)(?<!study\s)(?<!assessment\s)(?<!review\s)(?<!consultation\s)(?<!opinion\s)(?<!document\s)(?:adopted|approved)(?:(?!\bnot\b).)*?(?:regulation|directive|law|amendment|legislation)",
    ),
    "proposed": (
        r"(?:revision|revised|recast|decided|proposal|proposed|tabled)(?:(?!\bnot\b).)*?(?:regulation|directive|law|amendment|legislation|legislative)",
        r"(?:plans? for|committed? to|intends? to|will)(?:(?!\bnot\b).)*?(?:legislative proposal)",
        r"(?:plans? for|committed? to)(?:(?!\bnot\b).)*?(?:revision|review)(?:(?!\bnot\b).)*?(?:legislation|directive|regulation)",
        r"proposals? on(?:(?!\bnot\b).)*?(?:revision|review)(?:(?!\bnot\b).)*?(?:legislation|directive|regulation)",
    ),
    "planned": (
        r"(?:will apply|planned|to be adopted|foresees).*?(?:from|by|in).*?\d{4}",
        r"(?:created|creation|new|adopted|establish).*?(?:tariff codes?|cn codes?|standards)",
    ),
}

# Words of which every match of a status's patterns holds one: texts without them need not be searched.
LEGISLATIVE_SIGNS = {
    "law_active": ("became applicable", "applies from", "apply from"),
    "in_vacatio_legis": ("entered into force", "came into force"),
    "withdrawn": ("withdraw", "withdrew"),
    "adopted": ("adopted", "approved"),
    "proposed": ("revision", "revised", "review", "recast", "decided", "proposal", "proposed", "tabled"),
    "planned": ("will apply", "planned", "to be adopted", "foresees", "tariff code", "cn code", "standards"),
}

# Rows of a rule table: a label, groups of phrases (one of each group has to occur), and phrases none of which may occur.
# The first row that holds gives the label.

STUDIED_NOT = ("intention to table a legislative proposal", "became applicable")

STATUS_RULES = (
    ("applicable", (APPLICABLE,), ()),
    ("applicable", (("entered into force",), ADOPTED), ()),
    ("applicable", (("applies from", "apply from"), ("adopted", "regulation", "directive")), ()),
    ("adopted", (ADOPTED,), ()),
    ("committed", (COMMITTED,), ()),
    ("committed", (("to table a legislative proposal",), ("by",)), ()),
    ("assessment_pending", (("tasked",), ("efsa",), ("scientific opinion",)), STUDIED_NOT),
    ("assessment_pending", (("impact assessment",), ASSESSING), STUDIED_NOT),
    ("assessment_pending", (("will communicate",), ("by", "after")), STUDIED_NOT),
    ("roadmap_development", (("roadmap",), ROADMAP), ("became applicable",)),
    ("rejected_already_covered", (REFUSED, EXISTING), ("no repeal",)),
    ("rejected_already_covered", (REFUSED, EXISTING), ("was proposed",)),
    ("rejected_with_actions", (REFUSED, OTHER_ACTIONS), ()),
    ("rejected_with_actions", (("no repeal",), ("was proposed",), OTHER_ACTIONS), ()),
    ("rejected", (REFUSED,), ()),
    ("rejected", (("no repeal",), ("was proposed",)), ()),
    ("non_legislative_action", (FOCUS,), PROMISED),
    ("non_legislative_action", (MEASURES,), ("proposal",)),
    ("proposal_pending_adoption", (("proposal",), ("tabled",), ("rather than proposing new legislative acts",)), ("became applicable", "entered into force")),
)

REVISED, PROPOSED, PASSED = ("revision", "revised", "recast"), ("proposal", "proposed"), ("adopted", "adoption")

ACTION_RULES = (
    ("Tariff Codes Creation", (("tariff code",),), ()),
    ("Standards Adoption", (("standards",), ("minimum", "hygiene")), ()),
    ("Directive Revision", (REVISED, ("directive",)), ()),
    ("Regulation Revision", (REVISED, ("regulation",)), ()),
    ("Legislative Revision", (REVISED,), ()),
    ("Amendment", (("amendment",),), ()),
    ("Regulation Proposal", (PROPOSED, ("regulation",)), ()),
    ("Directive Proposal", (PROPOSED, ("directive",)), ()),
    ("Law Proposal", (PROPOSED, ("law",)), ()),
    ("Legislative Proposal", (PROPOSED,), ()),
    ("Regulation Adoption", (PASSED, ("regulation",)), ()),
    ("Directive Adoption", (PASSED, ("directive",)), ()),
    ("Law Adoption", (PASSED, ("law",)), ()),
    ("Legislative Adoption", (PASSED,), ()),
    ("Law Entered Into Force", (("entered into force", "became applicable"),), ()),
    ("Regulation Withdrawal", (("withdraw",), ("regulation",)), ()),
    ("Directive Withdrawal", (("withdraw",), ("directive",)), ()),
    ("Proposal Withdrawal", (("withdraw",),), ()),
)

# Words after which an action's date is looked for, by its status.
LEGISLATIVE_WORDS = {
    "law_active": ("applies from", "apply from", "rules apply from", "became applicable"),
    "in_vacatio_legis": ("entered into force", "came into force"),
    "withdrawn": ("withdrawn", "withdraw"),
    "adopted": ("adopted", "approved"),
    "proposed": ("proposal", "proposed", "tabled", "plans for", "committed to"),
    "planned": ("will apply", "planned", "foresees", "intends"),
}

# What makes a passage one about legislation, so that it is not another measure.
ABOUT_LAWS = (
    r"\bentered into force\b",
    r"\bbecame applicable\b",
    r"\bwithdrawal\b",
    r"\bdecided not to submit a legislative proposal\b",
    r"\bcome forward with a legislative proposal\b",
    r"\btable a legislative proposal\b",
    r"\bno new legislation\b",
    r"\bcame into force on\b",
    r"\bamendment to the directive\b",
    r"\bamendment to the regulation\b",
    r"\bamending directive\b",
    r"\bamending regulation\b",
    r"\brevision of legislation\b",
    r"\blabelling requirements\b",
    r"\bmandatory labelling\b",
    r"\bsets out plans for a legislative proposal\b",
)

# Names whose years are not dates of events.
PROGRAMMES = (
    "2030 Agenda",
    "Agenda 2030",
    "Europe 2020",
    "Horizon 2020",
    "Natura 2000",
    "Vision 2025",
    "Vision 2030",
    "Vision 2050",
    r"Industrie 4\.0",
    r"Industry 4\.0",
    "2020 Farm to Fork Strategy",
)
