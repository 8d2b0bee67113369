"""Fixed values that results depend on: word lists, lookup tables and patterns. They are defaults; every function takes others."""

from __future__ import annotations

#: Trailing legal words of organisation names.
LEGAL = "INC LLC LTD LIMITED CO CORP CORPORATION COMPANY GMBH AG SA SAS BV NV KG KGAA PLC LP LLP PTE PTY SRL SPA OY AB AS ULC".split()
#: Trailing salt and form words of substance names.
SALTS = "hydrochloride dihydrochloride hydrobromide sulfate sulphate sodium calcium potassium mesylate maleate tartrate acetate citrate succinate fumarate phosphate besylate monohydrate dihydrate anhydrous".split()
#: Trustees and collateral agents, which are not owners.
TRUSTEE = r"WILMINGTON|ANKURA|GLAS TRUST|COLLATERAL AGENT|ALTER DOMUS|U\.?\s?S\.?\s?BANK|UMB BANK|COMPUTERSHARE|ACQUIOM|WILMINGTON SAVINGS"
#: Chinese names of organisations.
CHINESE = [("诺华", "NOVARTIS"), ("吉利德", "GILEAD"), ("默克", "MERCK"), ("勃林格殷格翰", "BOEHRINGER INGELHEIM"), ("罗氏", "ROCHE"), ("辉瑞", "PFIZER"), ("阿斯利康", "ASTRAZENECA"), ("基因泰克", "GENENTECH"), ("缬图", "VENTUS"), ("米拉蒂", "MIRATI"), ("缆图", "BLUEPRINT"), ("锐新", "REVOLUTION")]
#: A word in the name, and the owner it stands for; the first that is contained counts.
OWNERS = [
    ("GILEAD", "GILEAD SCIENCES"), ("NOVARTIS", "NOVARTIS"), ("REVOLUTION", "REVOLUTION MEDICINES"), ("BOEHRINGER", "BOEHRINGER INGELHEIM"), ("ASTRAZENECA", "ASTRAZENECA"), ("ROCHE", "ROCHE"),
    ("GENENTECH", "ROCHE"), ("PFIZER", "PFIZER"), ("ARRAY", "PFIZER"), ("AMGEN", "AMGEN"), ("JANSSEN", "JANSSEN"), ("BEIGENE", "BEIGENE"), ("TAKEDA", "TAKEDA"), ("LILLY", "ELI LILLY"), ("LOXO", "ELI LILLY"),
    ("BLUEPRINT", "SANOFI"), ("INCYTE", "INCYTE"), ("EISAI", "EISAI"), ("ABBVIE", "ABBVIE"), ("PHARMACYCLICS", "ABBVIE"), ("SANOFI", "SANOFI"), ("VERTEX", "VERTEX"), ("BAYER", "BAYER"), ("MERCK", "MERCK"),
    ("BRISTOL", "BRISTOL MYERS SQUIBB"), ("MIRATI", "BRISTOL MYERS SQUIBB"), ("VENTUS", "VENTUS"), ("NIMBUS", "NIMBUS THERAPEUTICS"),
]
#: Words of academic sponsors.
ACADEMIC = ["univers", "hospital", "national", "institut", "college", "medical center", "medical centre", "foundation", "health system", "clinic", "cancer center", "assistance publique", "centre hospital"]
#: Patterns of the quality grade: out of scope, another modality, implausible symbols, methods.
EXCLUDE = r"SARS|\bCOV|CORONAVIR|ANTIVIR|\bVIRUS\b|VIRAL|\b3CL\b|\bMPRO\b|MAIN PROTEASE|HEPATITIS|\bHBV\b|\bHIV\b|INFLUENZA|ANTIBACTER|\bBACTERIAL|ANTIFUNG|ANTIBOD|ANTIGEN.BINDING|BISPECIFIC|NANOBODY|IMMUNOCONJUG|FUSION PROTEIN|CAR.T|VACCINE|OLIGONUCLEOT|SIRNA|\bMRNA\b|APTAMER|POLYMER|HYDROGEL|COPOLYMER|MICROCAPSULE|NANOPARTICLE|\bCOATING|\bRESIN\b|COSMETIC|SYNTHESIS OF|PROCESS FOR PREPAR|\bINTERMEDIATE\b"
DEGRADER = r"PROTAC|DEGRADER|MODULATORS? OF PROTEOLYSIS|MOLECULAR GLUE|PROTEOLYSIS.TARGETING|GLUTARIMIDE|PIPERIDINE-?2,6-?DIONE|OXOISOINDOLIN|CEREBLON|\bCRBN\b|THALIDOMIDE|LENALIDOMIDE|POMALIDOMIDE"
IMPLAUSIBLE = r"^(OR\d|TAS2R\d|OR\d+[A-Z])"
NOT_TARGET = r"^(?:NRN1L?|TPO|THPO)$|^COL\d"
METHOD = r"^\s*METHODS?\b|COMBINATION|THERAPY|DOSING|REGIMEN|RESISTAN|COMPRISING A\b"
#: Design fingerprint: weights and patterns; suspect from the threshold on.
FINGERPRINT = {
    "occupancy_timecourse": (r"target occupancy|receptor occupancy|target engagement|\boccupancy\b", 3),
    "sustained_pd": (r"resynthesis|duration of (?:target )?(?:inhibition|engagement)|recovery of \w+ (?:activity|protein|function)|sustained (?:target )?(?:inhibition|pharmacodynamic|engagement)|return to baseline", 2),
    "adduct_massspec": (r"covalent (?:bond|adduct|occupancy)|activity-based protein profiling|\bABPP\b|probe[- ]?(?:based )?occupancy|mass spectrometr\w+[^.]{0,40}(?:occupancy|adduct|engagement)", 3),
    "pbmc_pd": (r"\bPBMCs?\b", 1),
    "covalent_stated": (r"irreversibl\w+|covalent\w*", 3),
}
FINGERPRINT_LEAST = 4
#: Publication verdict: strong phrases, the bare word, and what speaks against it.
STRONG = r"covalent(?:ly)? (?:bind|bond|bound|adduct|modif)|\bCys(?:teine)?[\s-]?\d{2,4}\b|\bwarhead\b|acrylamide|Michael acceptor|butynamide|fluoroacrylamide|cyanoacryl"
WORD = r"irreversibl\w+|(?<!non[- ])(?<!non)covalent(?:ly)?\b"
AGAINST = r"non-?covalent|\breversible\b"
#: Chemical names that count where they read as nomenclature, and words around them that speak against it.
NOMENCLATURE = r"(?:acryl|prop-?2-?en|2-?propen)amide|(?:propiol|but-?2-?yn)amide|chloroacetamide|vinyl[\s-]?sulfon(?:amide|e)|epoxide|maleimid"
NOT_NOMENCLATURE = r"\b(?:gel|poly|polymer|excipient|column|purification|resin|hydrogel|coating)\b"
#: Names of leads in paragraphs, labels before them and data after them.
LEAD = r"prop-2-enamide|acrylamide|but-2-ynamide|propiolamide|cyanoacrylamide|prop-2-enenitrile|maleimid"
LEAD_LABEL = r"^(?:step\s+\d+[:.]?|example\s+\d+[A-Za-z]*[:.]?|compound\s+\d+[:.]?|title compound[,:]?)\s*"
LEAD_DATA = r"\s+(?:1H ?NMR|13C|LCMS|LC-MS|MS ?\(|ESI|δ|m/?z|HRMS|Yield|as a (?:white|pale|yellow|off|colou?r))"
#: Modalities that are not small molecules, probe studies, and classes that decide by themselves.
NOT_SMALL = r"\b\d{2,3}Lu\b|\b\d{2,3}Ga\b|\b\d{3}Ac\b|177Lu|68Ga|225Ac|\bLu-|\bGa-|PSMA|radioligand|radiopharma|\bCAR[- ]?T\b|chimeric antigen|lymphodeplet|fludarabine|mab\b|bispecific|\bantibody\b|conjugate|\bADC\b|siRNA|antisense|oligonucleotide|\bmRNA\b|vaccine|cell therapy|\bTCR\b|CRISPR|peptide"
PROBE = r"bioavailab|drug.drug interaction|\bDDI\b|mass balance|food effect|midazolam|cocktail"
BY_CLASS = r"\bG12C\b|\bG12S\b|exon\s?20\s?ins"
#: Words in capitals that are not symbols.
STOP = "FOR AND THE NOT ALL ANY MAY CAN HAS HAD WAS ARE BUT NEW USE VIA PER OUR OFF OUT WHO HOW NOW OWN WAY ITS ONE TWO NON PRE".split()
#: Verdicts in the order of the dossier, and covalency and novelty in that of the digest.
VERDICTS = {"OPEN": 0, "?": 1, "TAKEN": 2, "TRAP": 3}
COVALENCY = {"LIKELY": 0, "FINGERPRINT": 1, "POSSIBLE": 2, "NONE": 3}
NOVELTY = {"NOVEL": 0, "EMERGING": 1, "KNOWN": 2}
