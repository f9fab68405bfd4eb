"""Patterns for span search, document classes and relation grammars.

Patterns of spans and classes ignore case, except for those named in CASED. They mean the same to Python's re and, with the flag U, to Java's.
Grammars are written in fragments ({ENT}, {ACTOR} and so on) that grammar_patterns() puts in; their groups are named by slots.
"""

from __future__ import annotations

import re

# Span categories with their named patterns, in the order in which they are tried.
SPANS = {
    "OWNERSHIP_EXPLICIT": {
        "beneficial_owner": r"\bbeneficial(?:ly)?[- ]own(?:er(?:s|ship)?|ed|s)\b",
        "owned_by": r"\bowned\s+(?:and\s+(?:operated|controlled)\s+)?by\b",
        "owns_stake": r"\bowns?\b[^.\n]{0,60}\b(?:percent|%|shares?|interests?|stakes?|equity)\b",
        "pct_ownership": r"\b\d{1,3}(?:\.\d+)?\s?(?:%|percent)\s+(?:(?:of\s+)?(?:the\s+)?(?:issued\s+|outstanding\s+|voting\s+|total\s+)*(?:shares?|stock|equity|membership\s+interests?|ownership|interests?\s+in|units|common\s+stock|voting\s+power)|owner(?:ship)?|stake|shareholder)\b",
        "ownership_interest": r"\b(?:ownership|equity|controlling|membership)\s+interests?\b",
        "sole_majority_owner": r"\b(?:sole|majority|minority|principal|part|co-)\s*owner(?:s|ship)?\b",
        "shareholder_of": r"\b(?:(?:sole|majority|minority|principal|controlling)\s+)?(?:shareholder|stockholder)s?\s+of\b|\b(?:sole|managing|founding|majority)\s+members?\s+of\b",
        "owner_of": r"\bowners?\s+of\b[^.\n]{0,80}\b(?:LLC|L\.L\.C\.|Inc\.?|Corp\.?|Company|Ltd\.?|LP\b|LLP\b)",
    },
    "CONTROL_EXPLICIT": {
        "controlled_by": r"\bcontrolled\s+by\b",
        "under_control": r"\bunder\s+the\s+control\s+of\b",
        "exercises_control": r"\bexercis\w+\s+(?:substantial\s+|significant\s+)?control\b",
        "substantial_control": r"\bsubstantial\s+control\b",
        "controlling_person": r"\bcontrolling\s+(?:person|party|shareholder|stockholder|member|entity)s?\b",
        "controls_entity": r"\b(?:controls|controlling|control\s+(?:of|over))\b[^.\n]{0,60}\b(?:LLC|L\.L\.C\.|Inc\.?|Corp(?:oration)?\.?|Company|Ltd\.?|entit(?:y|ies)|compan(?:y|ies))\b",
    },
    "PARENT_SUBSIDIARY": {
        "wholly_owned_sub": r"\bwholly[- ]owned\s+subsidiar(?:y|ies)\b",
        "subsidiary_of": r"\bsubsidiar(?:y|ies)\s+of\b",
        "subsidiary": r"\bsubsidiar(?:y|ies)\b",
        "parent_co": r"\bparent\s+(?:company|corporation|entity|organization|bank|holding)\b",
        "holding_co": r"\bholding\s+compan(?:y|ies)\b",
        "affiliate": r"\baffiliat(?:e[sd]?|ion)\b[^.\n]{0,60}\b(?:of|with)\b",
        "dba_fka": r"\b(?:d/b/a|f/k/a|a/k/a|doing\s+business\s+as|formerly\s+known\s+as|also\s+known\s+as)\b",
    },
    "SHELL_NOMINEE": {
        "shell": r"\bshell\s+(?:compan(?:y|ies)|corporation|corp|entit(?:y|ies)|firm)s?\b",
        "front_co": r"\bfront\s+(?:compan(?:y|ies)|business(?:es)?|entit(?:y|ies))\b",
        "nominee": r"\bnominee(?:s|\s+(?:owner|director|shareholder|officer|account))?\b",
        "straw": r"\bstraw\s+(?:owner|man|men|purchaser|buyer|borrower|donor)s?\b",
        "spv": r"\bspecial\s+purpose\s+(?:vehicle|entit(?:y|ies))\b|\bSPV\b",
        "shelf_co": r"\bshelf\s+compan(?:y|ies)\b",
        "alter_ego": r"\balter\s+ego\b",
        "intermediary_layer": r"\b(?:layering|layered\s+(?:through|entities)|intermediar(?:y|ies))\b",
    },
    "ROLE_TITLE": {
        "registered_agent": r"\bregistered\s+agents?\b",
        "managing_member": r"\b(?:managing|sole)\s+members?\b",
        "organizer": r"\b(?:organizer|incorporator)s?\b",
        "officer_of": r"\b(?:president|chief\s+executive\s+officer|CEO|chief\s+financial\s+officer|CFO|secretary|treasurer|director|principal|founder|chairman|chairwoman|managing\s+director|general\s+partner)\b[^.\n]{0,40}\bof\b[^.\n]{0,80}\b(?:LLC|L\.L\.C\.|Inc\.?|Corp\.?|Company|Ltd\.?|Bank|Group|Holdings?)\b",
        "member_manager_llc": r"\b(?:member|manager)s?\b[^.\n]{0,50}\b(?:LLC|L\.L\.C\.|limited\s+liability)\b",
        "trustee_settlor": r"\b(?:trustee|settlor|grantor)s?\b",
        "signatory": r"\b(?:authorized\s+)?signat(?:ory|ories|ures?\s+authority)\b|\bauthorized\s+signer\b",
        "on_behalf": r"\bon\s+behalf\s+of\b",
    },
    "FINANCIAL_FLOW": {
        "wire_transfer": r"\bwire\s+transfers?\b|\bwired\b",
        "transferred_amt": r"\btransferr?(?:ed|ing)?\b[^.\n]{0,60}\$\s?[\d,]+",
        "dollar_flow": r"\$\s?[\d,]{4,}(?:\.\d{2})?[^.\n]{0,60}\b(?:to|from|into|through)\b",
        "bank_account": r"\bbank\s+accounts?\b|\baccount\s+(?:number|ending|held)\b",
        "proceeds": r"\b(?:criminal\s+|illicit\s+|fraud\s+)?proceeds\b[^.\n]{0,60}\b(?:transferred|laundered|deposited|wired|funneled|diverted)\b",
        "funnel": r"\bfunnel(?:ed|ing)?\s+(?:account|money|funds)s?\b",
        "payment_to": r"\bpayments?\s+(?:to|from)\b[^.\n]{0,80}\b(?:LLC|Inc\.?|Corp\.?|account|bank)\b",
        "beneficiary_recipient": r"\b(?:beneficiary|recipient|payee|remitter|originator)\b[^.\n]{0,50}\b(?:of|account|wire|transfer|payment)\b",
    },
    "SAR_BSA": {
        "sar": r"\bsuspicious\s+activity\s+reports?\b|\bSARs?\b",
        "bsa": r"\bbank\s+secrecy\s+act\b|\bBSA\b",
        "aml": r"\banti[- ]money[- ]launder\w+\b|\bAML\b",
        "ctr": r"\bcurrency\s+transaction\s+reports?\b|\bCTRs?\b",
        "money_laundering": r"\bmoney\s+launder\w+\b|\blaunder(?:ed|ing)\b",
        "structuring": r"\bstructur(?:ed|ing)\s+(?:cash\s+)?(?:deposits?|transactions?|withdrawals?)\b",
        "gto": r"\bgeographic\s+targeting\s+orders?\b",
        "314": r"\b314\s?\(\s?[ab]\s?\)",
    },
    "BOI_CTA": {
        "boi": r"\bbeneficial\s+ownership\s+information\b|\bBOI\b",
        "cta": r"\bcorporate\s+transparency\s+act\b",
        "boss": r"\bbeneficial\s+ownership\s+secure\s+system\b|\bBOSS\b",
        "boi_rule": r"\b(?:BOI|beneficial\s+ownership)\s+(?:report(?:s|ing)?|rule|requirements?|database|registry)\b",
        "reporting_company": r"\breporting\s+compan(?:y|ies)\b",
        "company_applicant": r"\bcompany\s+applicants?\b",
        "fincen_id": r"\bFinCEN\s+identifiers?\b",
        "cta_cite": r"\b31\s+U\.?S\.?C\.?\s+(?:§+\s*)?5336\b|\b1010\.380\b",
        "access_rule": r"\bbeneficial\s+ownership[^.\n]{0,40}\baccess\b|\baccess\s+rule\b",
    },
    "FORMATION_DISSOLUTION": {
        "formation_docs": r"\b(?:articles\s+of\s+(?:incorporation|organization)|certificate\s+of\s+(?:formation|incorporation|organization))\b",
        "incorporated_in": r"\b(?:incorporated|organized|formed|registered|chartered)\s+(?:in|under|on)\b",
        "dissolution": r"\bdissolv(?:ed|ution)\b|\bwound\s+up\b|\bwinding\s+up\b",
        "merger": r"\bmerg(?:er|ed|ing)\b[^.\n]{0,60}\b(?:with|into|of)\b",
        "acquired": r"\bacquir(?:ed|es|ing|isition)\b[^.\n]{0,60}\b(?:of|by|from)\b",
    },
}
CASED = frozenset(("spv", "sar", "bsa", "aml", "ctr", "boi", "boss", "BOSS", "BSA_AML", "SAR_RELATED"))
# Structures whose groups are captured, in the order in which they are tried; case counts.
FORMS = r"(?:LLC|L\.L\.C\.|Inc\.?|Corp\.?|Corporation|Company|Co\.|Ltd\.?|LP|LLP|Group|Holdings?|Bank|Trust)"
STRUCTURED = {
    "person_role_entity": r"\b([A-Z][a-z]+(?:\s+[A-Z]\.?)?\s+[A-Z][a-z]+(?:-[A-Z][a-z]+)?)\s*,?\s+(?:the\s+|a\s+|its\s+|former\s+)?(president|chief executive officer|CEO|chief financial officer|CFO|owner|co-owner|manager|managing member|sole member|member|director|officer|principal|founder|chairman|secretary|treasurer|registered agent|organizer|incorporator|trustee|beneficial owner)\s+(?:and\s+\w+\s+)?of\s+([A-Z][\w&.,'’\- ]{2,60}?" + FORMS + ")",
    "entity_owned_by": r"\b([A-Z][\w&.,'’\- ]{2,60}?" + FORMS + r")\s*,?\s+(?:which\s+)?(?:is|was)?\s*(?:owned|controlled|owned\s+and\s+controlled|beneficially\s+owned)\s+(?:in\s+part\s+)?by\s+([A-Z][\w&.,'’\- ]{2,60})",
    "entity_subsidiary_of": r"\b([A-Z][\w&.,'’\- ]{2,60}?)\s*,?\s+(?:is\s+|was\s+)?an?\s+(?:wholly[- ]owned\s+|indirect\s+|direct\s+)?subsidiary\s+of\s+([A-Z][\w&.,'’\- ]{2,60})",
    "pct_of_entity": r"\b(\d{1,3}(?:\.\d+)?)\s?(?:%|percent)\s+of\s+(?:the\s+)?(?:issued\s+|outstanding\s+|voting\s+|total\s+)*(?:membership\s+interests?|equity|shares?|stock|ownership|units)\s+(?:of|in)\s+([A-Z][\w&.,'’\- ]{2,60})",
}
# Document classes with their patterns.
CLASSES = {
    "BOI_CTA": r"\bbeneficial\s+ownership\s+information\b|\bcorporate\s+transparency\s+act\b|\b31\s+U\.?S\.?C\.?\s+(?:§+\s*)?5336\b|\b1010\.380\b|\bFinCEN\s+identifier\b",
    "BOSS": r"\bbeneficial\s+ownership\s+secure\s+system\b|\bBOSS\b",
    "BENEFICIAL_OWNERSHIP": r"\bbeneficial(?:ly)?[- ]own",
    "CORPORATE_OWNERSHIP": r"\bowned\s+by\b|\bownership\s+interest\b|\bequity\s+interest\b|\bcontrolling\s+interest\b|\bshareholder\b|\bstockholder\b",
    "SUBSTANTIAL_CONTROL": r"\bsubstantial\s+control\b|\bcontrolled\s+by\b|\bunder\s+the\s+control\s+of\b",
    "PARENT_SUBSIDIARY": r"\bsubsidiar(?:y|ies)\b|\bparent\s+(?:company|corporation|holding)\b|\bholding\s+compan",
    "SHELL_COMPANY": r"\bshell\s+(?:compan|corporation|entit)|\bfront\s+compan|\bshelf\s+compan",
    "ENTITY_FORMATION": r"\barticles\s+of\s+(?:incorporation|organization)\b|\bcertificate\s+of\s+formation\b|\bcompany\s+formation\b|\bformation\s+agent",
    "ENTITY_DISSOLUTION": r"\bdissolution\b|\bdissolved\b|\badministratively\s+dissolved\b",
    "MERGER_ACQUISITION": r"\bmergers?\s+and\s+acquisitions?\b|\bmerger\s+agreement\b|\bacquisition\s+of\b|\bmerged\s+(?:with|into)\b",
    "OFFICER_DIRECTOR": r"\b(?:officers?\s+and\s+directors?|board\s+of\s+directors|chief\s+executive\s+officer|president\s+of)\b",
    "MEMBER_MANAGER": r"\bmanaging\s+member\b|\bsole\s+member\b|\bmember[- ]managed\b|\bmanager[- ]managed\b",
    "REGISTERED_AGENT": r"\bregistered\s+agents?\b",
    "TRUST_NOMINEE": r"\bnominee\b|\btrustee\b|\bsettlor\b|\bgrantor\s+trust\b",
    "FINANCIAL_TRANSACTION": r"\bwire\s+transfer|\btransferred\s+\$|\bfunds\s+transfer|\bmonetary\s+transactions?\b",
    "WIRE_TRANSFER": r"\bwire\s+transfers?\b|\bwired\s+\$",
    "BANK_ACCOUNT": r"\bbank\s+accounts?\b|\baccount\s+(?:number|ending)\b|\bcorrespondent\s+account",
    "BSA_AML": r"\bbank\s+secrecy\s+act\b|\banti[- ]money[- ]launder|\bAML\b|\bBSA\b",
    "SAR_RELATED": r"\bsuspicious\s+activity\s+report|\bSARs?\b",
    "ENFORCEMENT": r"\bconsent\s+order\b|\bcease\s+and\s+desist\b|\bcivil\s+money\s+penalt|\benforcement\s+action|\bsettlement\s+agreement\b|\bdeferred\s+prosecution\b|\bplea(?:ded|d)?\s+guilty\b|\bindictment\b|\bconvicted\b|\bsentenced\b",
    "INVESTIGATION": r"\binvestigat(?:ion|ed|ing|ors)\b|\bprobe\b|\bsubpoena",
    "CONGRESSIONAL_EVIDENCE": r"\bcommittee\s+on\s+(?:oversight|financial\s+services|banking|judiciary)\b|\bcongressional\s+(?:hearing|testimony|report)\b|\bexhibits?\s+\d+\b|\bhearing\s+before\b|\bwritten\s+testimony\b",
    "COURT_RECORD": r"\bunited\s+states\s+district\s+court\b|\bplaintiff\b|\bdefendant\b|\bcase\s+no\.\b|\bcivil\s+action\b|\bcriminal\s+complaint\b|\bdocket\b",
    "REAL_ESTATE": r"\breal\s+(?:estate|property)\b|\bresidential\s+(?:purchase|real)\b|\btitle\s+insurance\b|\ball[- ]cash\s+purchase|\bdeed\b",
    "PROCUREMENT": r"\bprocurement\b|\bfederal\s+contract(?:or|s)?\b|\bSAM\.gov\b|\bsolicitation\s+number\b",
    "SEC_OWNERSHIP": r"\bschedule\s+13[dg]\b|\bform\s+[34]\b[^.\n]{0,40}ownership|\bsection\s+16\b|\b10\s?%\s+owner|\bbeneficial\s+ownership\s+report",
    "SEC_SUBSIDIARY": r"\bexhibit\s+21\b|\bsubsidiaries\s+of\s+the\s+registrant\b",
    "UCC": r"\bUCC(?:-1|-3)?\s+(?:filing|financing\s+statement)\b|\buniform\s+commercial\s+code\b",
    "SANCTIONS": r"\bOFAC\b|\bspecially\s+designated\s+nationals?\b|\bsanction(?:s|ed)\b|\bblocked\s+propert",
    "LICENSING": r"\blicens(?:e[sd]?|ing)\b[^.\n]{0,40}\b(?:money\s+(?:transmitter|services)|MSB|casino|bank)|money\s+services\s+business",
}
# Fragments of names, numbers and qualifiers, each made of those before it.
FRAGMENTS = {
    "SUFFIX": r"(?i:LLC|L\.L\.C\.|Inc\.?|Corp\.?|Corporation|Company|Co\.|Ltd\.?|Limited|Incorporated|LP|L\.P\.|LLP|PLLC|PLC|GmbH|N\.V\.|Holdings?|Group|Trust|Bank|Bancorp|Bancshares|N\.A\.|S\.?A\.?R\.?L\.?|Partners(?:hip)?|Fund|Association)",
    "MIDSTOP": r"(?:through|another|other|certain|various|his|her|their|its|such|any|each|that|which|who|whose|is|was|are|were|and|or|(?i:LLC|L\.L\.C\.|Inc\.?|Corp\.?|Ltd\.?|LP|LLP|PLLC|PLC|N\.A\.)(?=[\s.,]))",
    "ENT": r"(?:[A-Z][A-Za-z0-9&.'’\-]*(?:\s+(?!{MIDSTOP}\s)[A-Za-z0-9&.'’\-]+){0,7}?[,]?\s+{SUFFIX})",
    "PREFIX_ENT": r"(?:(?:(?:Limited\s+)?Liability\s+Compan(?:y|ies)|(?:Open|Closed|Public|Private)\s+Joint[- ]Stock\s+Company|Joint[- ]Stock\s+Company|OOO|OAO|ZAO|PAO)\s+[A-Z][A-Za-z0-9'’&.\-]*(?:\s+[A-Z][A-Za-z0-9'’&.\-]*){0,3})",
    "DEFENT": r"(?:[Tt]he\s+(?:[Pp]roposed\s+)?(?:Bank|Company|Corporation|Trust|Venture|Fund|Association|Partnership|Firm|Institution))",
    "PERSON": r"(?:[A-Z][a-z]+(?:\s+[A-Z]\.?)?(?:\s+[A-Z][A-Za-z'’\-]*[a-z]){1,2})",
    "PERSON_CAPS": r"(?:[A-Z][A-Z'’\-]+(?:\s+[A-Z]\.?)?(?:\s+[A-Z][A-Z'’\-]+){1,2})",
    "SURNAME": r"(?:[A-Z][a-z]+[A-Za-z'’\-]*[a-z])",
    "CODE": r"(?:[A-Z]{1,4}-\d{1,3})",
    "TITLECASE": r"(?:[A-Z][A-Za-z0-9'’&.\-]*(?:\s+(?:of|the|de|la|del|al|el)\s+[A-Z][A-Za-z0-9'’&.\-]*|\s+[A-Z][A-Za-z0-9'’&.\-]*){0,6})",
    "ACTOR": r"(?:{PREFIX_ENT}|{ENT}|{DEFENT}|{PERSON_CAPS}|{PERSON}|{CODE})",
    "NAMELIST": r"(?:{SURNAME}|{PERSON})(?:,\s+(?:{SURNAME}|{PERSON})){1,6}(?:,?\s+and\s+(?:{SURNAME}|{PERSON}|their\s+affiliated\s+entities))?",
    "PCT": r"(?P<percentage>\d{1,3}(?:\.\d+)?)\s?(?:%|percent)",
    "QUAL": r"(?P<qualifier>sole|majority|minority|principal|controlling|co-|part|50/50|indirect|beneficial)",
    "SUBQUAL": r"(?P<qualifier>(?:direct|indirect|wholly[- ]\s*owned|majority[- ]owned)(?:,?\s+(?:direct|indirect|wholly[- ]\s*owned|majority[- ]owned))*)",
    "NUM": r"\d{1,3}(?:,\s?\d{3})+(?:\.\d{2})?|[\d,]+(?:\.\d{2})?",
    "AMT": r"\$\s?(?P<amount>{NUM})\s*(?P<scale>million|billion)?(?:\s*(?:to|and|–|—|-)\s*\$?\s?(?:{NUM})\s*(?:million|billion)?)?",
    "HOLDS": r"(?:currently\s+|indirectly\s+|directly\s+)?(?:owns?|owned|holds?|held|acquired|purchased|obtained|retains?|retained|will\s+own|would\s+own)\s+(?:approximately\s+|about\s+|at\s+least\s+|up\s+to\s+)?",
    "ABOUT": r"(?:approximately\s+|about\s+|at\s+least\s+|more\s+than\s+)?",
    "ACCOUNT": r"[\w\s]{0,40}account",
}
# Relation grammars (tier, predicate, pattern), in the order in which they are tried.
GRAMMARS = [
    ("A", "owned_by", r"(?P<object>{ENT}|{DEFENT}|{TITLECASE})\s*(?:\([^)]{0,60}\)\s*)?(?:,\s*(?:which|and)\s+)?(?:is|was|were|are)\s+(?:an?\s+[\w\s-]{0,30}\s+)?(?:beneficially\s+)?owned(?:\s+and\s+(?:operated|controlled|managed))?\s+by\s+(?P<subject>{NAMELIST}|{ACTOR})"),
    ("A", "owns_pct_of", r"(?P<subject>{ACTOR}|{TITLECASE})\s+{HOLDS}{PCT}\s+of\s+(?:the\s+)?(?:[\w\s-]{0,40}?\s+)?(?:shares?|stock|equity|interests?|units|membership\s+interests?|ownership)?\s*(?:of|in)?\s*(?P<object>{ENT}|{DEFENT})"),
    ("A", "pct_interest_in", r"(?P<subject>{ACTOR}|{TITLECASE})\s+{HOLDS}(?:an?\s+)?{PCT}\s+(?:ownership|equity|membership|profits?)\s+interests?\s+in\s+(?:the\s+)?(?P<object>{ENT}|{DEFENT}|{TITLECASE})"),
    ("A", "owner_of", r"(?P<subject>{PERSON})\s*,?\s*(?:is|was|as)?\s*(?:the|a)\s+{QUAL}?\s*owner(?:\s+and\s+[\w\s]{0,25})?\s+of\s+(?P<object>{ENT})"),
    ("A", "owner_of_appositive", r"(?P<subject>{ACTOR}|{SURNAME})\s*,\s*(?:the|a)\s+{QUAL}?\s*(?:beneficial\s+)?owner\s+of\s+(?:the\s+)?(?P<object>{ENT}|{DEFENT}|{TITLECASE})"),
    ("A", "founder_sole_owner", r"(?P<subject>{PERSON})\s+(?:is|was)\s+the\s+(?:founder\s+and\s+)?{QUAL}\s+(?:owner|shareholder|stockholder|member)(?:\s*,\s*officer)?(?:\s*,?\s*and\s+director)?\s+(?:of|to)\s+(?P<object>{ENT})"),
    ("A", "beneficial_owner_of", r"(?P<subject>{ACTOR})\s*(?:,[^,]{0,60},)?\s*(?:is|was|became)\s+(?:the|a)\s+(?:sole\s+)?beneficial\s+owner\s+of\s+(?:[\w\s]{0,30}?)(?P<object>{ENT}|{ACCOUNT})"),
    ("A", "holds_shares_of", r"(?P<subject>{ENT})\s+holds\s+{PCT}\s+of\s+the\s+shares(?:\s+(?:of|in)\s+(?:the\s+)?(?P<object>{ENT}|{TITLECASE}))?"),
    ("B", "controlled_by", r"(?P<object>{ENT}|{DEFENT}|{TITLECASE})\s*(?:,[^,]{0,80},)?\s*(?:is|was|were|are)\s+(?:owned\s+(?:and/or\s+|or\s+|and\s+)?)?controlled\s+by\s+(?P<subject>{NAMELIST}|{ACTOR})"),
    ("B", "designated_owned_controlled", r"(?P<object>{ENT})\s+(?:was|is|were)\s+designated\s+for\s+being\s+owned\s+or\s+controlled\s+by\s+(?P<subject>{ACTOR})"),
    ("B", "designation_controller", r"designated(?:\s+today)?(?:\s+pursuant\s+to[^,.]{0,40})?\s+for\s+being\s+owned\s+or\s+controlled\s+by\s*(?:,[^,]{0,120},)?\s*(?:directly\s+or\s+indirectly,\s*)?(?P<subject>{ACTOR}|{SURNAME})"),
    ("B", "controls", r"(?P<subject>{ACTOR})\s+(?:owns\s+and\s+)?controls\s+(?P<object>{ENT})"),
    ("B", "controlling_person_of", r"(?P<subject>{ACTOR})\s*,?\s*(?:is|was|as)?\s*(?:the|a)\s+controlling\s+(?:person|shareholder|stockholder|member|party)\s+of\s+(?P<object>{ENT})"),
    ("B", "exercises_control", r"(?P<subject>{ACTOR})\s+exercise[sd]?\s+(?:substantial\s+|significant\s+|complete\s+)?control\s+over\s+(?P<object>{ENT})"),
    ("C", "subsidiary_of", r"(?P<object>{ENT}|{DEFENT})\s*(?:\([^)]{0,40}\)\s*)?,?\s*(?:is|was|will\s+(?:be|remain)|would\s+(?:be|remain)|remains?|became)\s+an?\s+{SUBQUAL}?\s*subsidiary\s+of\s+(?:the\s+)?(?P<subject>{ENT}|{DEFENT}|{TITLECASE})"),
    ("C", "subsidiary_of_appositive", r"(?P<object>{ENT})\s*(?:\([^)]{0,60}\)\s*)?,\s*an?\s+{SUBQUAL}?\s*subsidiary\s+of\s+(?:the\s+)?(?P<subject>{ENT}|{DEFENT}|{TITLECASE})"),
    ("C", "parent_of", r"(?P<subject>{ENT})\s*,?\s*(?:is|was)\s+the\s+parent\s+(?:company|corporation|holding\s+company)\s+of\s+(?P<object>{ENT})"),
    ("C", "holding_company_of", r"(?P<subject>{ENT})\s*(?:,\s*|\s+(?:is|was|became)\s+)(?:the|a)\s+(?:bank\s+|savings\s+and\s+loan\s+|thrift\s+)?holding\s+company\s+(?:of|for)\s+(?:the\s+)?(?P<object>{ENT}|{DEFENT})"),
    ("C", "affiliate_of", r"(?P<subject>{ENT})\s*(?:,\s*|\s+(?:is|was|remains?|became)\s+)an?\s+affiliate\s+of\s+(?:the\s+)?(?P<object>{ENT}|{DEFENT})"),
    ("C", "alias_of", r"(?P<subject>{ACTOR}|{SURNAME})\s*,?\s+(?:d/b/a|a/k/a|f/k/a|n/k/a|a/d/b/a|doing\s+business\s+as)\s+(?P<object>{ENT}|{TITLECASE}|[A-Z][A-Z0-9&.,'’\s\-]{2,60})"),
    ("C", "its_subsidiary", r"(?P<subject>{ENT})\s*,?\s+(?:and\s+)?its\s+(?P<qualifier>wholly[- ]owned\s+)?subsidiar(?:y|ies)\s*,?\s+(?P<object>{ENT})"),
    ("C", "operates_through_sub", r"(?P<subject>{ENT})[^.\n]{0,60}?operates\s+through\s+(?P<object>{ENT})\s*,?\s+(?:its|a)\s+(?P<qualifier>wholly[- ]?\s*owned)?\s*subsidiary"),
    ("D", "shell_named", r"(?P<object>{ENT})\s*(?:,[^,]{0,60},)?\s*(?:is|was|were)\s+(?:nothing\s+more\s+than\s+|merely\s+|simply\s+)?an?\s+(?P<qualifier>shell|front|shelf|nominee|sham)\s+(?:compan(?:y|ies)|corporation|entit(?:y|ies))"),
    ("D", "used_shells", r"(?P<subject>{ACTOR})\s+(?:used|created|formed|established|set\s+up)\s+(?P<object>{ENT})\s*(?:,[^,]{0,60},)?\s+as\s+a?\s*(?P<qualifier>shell|front|nominee|conduit)"),
    ("D", "nominee_for", r"(?P<subject>{ACTOR})\s*,?\s*(?:acted|acting|served|serving)\s+as\s+(?:a\s+)?nominee\s+(?:owner\s+)?(?:for|of)\s+(?P<object>{ACTOR})"),
    ("E", "transferred_to", r"(?P<subject>{ACTOR}|{TITLECASE})\s+(?:wired|transferred|sent|paid|funneled|diverted|deposited)\s+(?:between\s+)?{ABOUT}{AMT}[^.\n]{0,120}?\s+(?:to|into)\s+(?P<object>{ACTOR}|{TITLECASE}|[\w\s]{0,30}account[\w\s]{0,30})"),
    ("E", "received_from", r"(?P<object>{ACTOR}|{TITLECASE})\s+(?:received|obtained|collected|raised)\s+{ABOUT}{AMT}\s+(?:from|through)\s+(?P<subject>{ACTOR}|{TITLECASE}|[\d,]+\s+investors)"),
    ("E", "wire_from_to", r"wire\s+transfer\s+of\s+{AMT}\s+from\s+(?P<subject>{ACTOR}|{ACCOUNT})\s+to\s+(?P<object>{ACTOR}|{ACCOUNT})"),
]
# Citations (hosts of records, report numbers) and the words that make them topical.
CITED_URL = r"(?i)https?://(?:www\.)?(congress\.gov|gao\.gov|govinfo\.gov|fincen\.gov|justice\.gov)(/[\w\-./%?=&#+]*)"
REPORT_NUMBER = r"\bGAO[- ](\d{2})[- ](\d{2,4}[A-Z]{0,3})\b"
TOPIC = r"(?i)beneficial ownership|corporate transparency|BOI\b|BOSS\b|shell compan|money launder|bank secrecy|\bBSA\b|\bSAR\b|\bAML\b|FinCEN|financial crimes|corporate ownership|anonymous compan"
#: Every match of a span or structure holds one of these, in any case.
SPAN_HINT = (
    r"(?i)own|control|subsidiar|parent\s|holding\s|affiliat|/[kb]/a|doing\s+business|known\s+as|shell\s|front\s|nominee|straw\s|special\s+purpose|SPV|shelf\s|alter\s|layer|intermediar|registered|member|organiz|incorporat|\sof\b|manager|trustee|settlor"
    r"|grantor|signat|signer|behalf|wire|transfer|\$|account|proceeds|funnel|payment|payee|remitter|originator|beneficiary|recipient|suspicious|SAR|secrecy|BSA|launder|AML|currency|CTR|structur|geographic|314|BOI|transparency|BOSS|reporting|applicant|FinCEN"
    r"|5336|1010\.380|access|articles|certificate|formed|chartered|dissolv|wound|winding|merg|acqui|%|percent|stockholder|shareholder"
)


def _put_in(pattern: str) -> str:
    """The pattern with fragments for their names; a slot that a fragment names stays a group once."""
    while True:
        new = re.sub(r"\{([A-Z_]+)\}", lambda m: FRAGMENTS[m[1]], pattern)
        if new == pattern:
            return pattern
        pattern = new


def span_patterns() -> list[tuple[str, str, re.Pattern[str]]]:
    """(category, name, pattern); patterns of the category STRUCTURED have groups."""
    plain = [(category, name, re.compile(p, 0 if name in CASED else re.I)) for category, patterns in SPANS.items() for name, p in patterns.items()]
    return plain + [("STRUCTURED", name, re.compile(p)) for name, p in STRUCTURED.items()]


def class_patterns() -> list[tuple[str, str]]:
    """(class, pattern for the JVM)."""
    return [(name, f"(?{'' if name in CASED else 'i'}U){p}") for name, p in CLASSES.items()]


def grammar_patterns() -> list[tuple[str, str, re.Pattern[str]]]:
    return [(tier, name, re.compile(_put_in(p))) for tier, name, p in GRAMMARS]
