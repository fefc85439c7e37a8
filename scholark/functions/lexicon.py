"""Fixed values of the extractors: patterns, word lists and their order, as results depend on them."""

from __future__ import annotations

Table = tuple[tuple[str, tuple[str, ...]], ...]

# Direction of a statement, the first that is found.
DIRECTIONS: Table = (
    ("increased", (
        r"\bincreas(ed|e|ing)\b", r"\bhigher\b", r"\belevat(ed|e|ing)\b", r"\benrich(ed|ment)\b", r"\bupregulat(ed|ion)\b", r"\bmore abundant\b", r"\bgreater abundance\b",
        r"\boverrepresent(ed|ation)\b", r"\bexpand(ed|ing)\b", r"\bpromot(ed|es|ing)\b", r"\benhance(d|s|ment)\b", r"\bpositively associated\b", r"\bpositive(ly)? correlat\b",
        r"\baccumulat(ed|ion)\b", r"\babundant\b", r"\bprevalent\b", r"\bcoloniz(ed|ation)\b", r"\bpresent(ed)? in\b", r"\bdetect(ed)? in\b", r"\bidentif(ied|y) in\b",
    )),
    ("decreased", (
        r"\bdecreas(ed|e|ing)\b", r"\blower\b", r"\breduc(ed|e|ing|tion)\b", r"\bdeplet(ed|ion)\b", r"\bdownregulat(ed|ion)\b", r"\bless abundant\b", r"\blower abundance\b",
        r"\bunderrepresent(ed|ation)\b", r"\bdiminish(ed|ing)\b", r"\bimpair(ed|ment)\b", r"\bnegatively associated\b", r"\bnegative(ly)? correlat\b", r"\bloss of\b", r"\babsent\b",
        r"\beradicat(ed|ion)\b", r"\beliminate(d|s)\b", r"\bsuppress(ed|ion)\b",
    )),
    ("no_change", (r"\bno (significant )?change\b", r"\bno (significant )?difference\b", r"\bunchanged\b", r"\bsimilar\b", r"\bno significant\b")),
    ("associated", (
        r"\bimplicat(ed|es|ing)\b", r"\brole\s+(in|of)\b", r"\bbiomarker\b", r"\bpathobiont\b", r"\bdysbiosis\b", r"\bdysbiotic\b", r"\bprotective\b", r"\blinked\s+to\b",
        r"\bcontribut(or|es|ing|ed)\s+(to|in)\b", r"\bmarker\s+(of|for)\b", r"\bsignature\s+(of|for)\b", r"\binvolv(ed|ement)\b", r"\bcorrelat(ed|ion)\b", r"\brelated\s+to\b",
        r"\bpathogen(ic|esis)?\b", r"\bcommensal\b", r"\bmutualist(ic)?\b", r"\bsymbio(nt|tic|sis)\b", r"\bdominant\b", r"\bkey\s+(species|taxon|organism|member)\b", r"\bdiffered\s+significantly\b",
    )),
)
# The number of a p-value, and the forms of effect sizes, the first that is found.
P_NUMBER = r"(0?\.\d+|[01]\.?\d*)"
P_FORMS = (r"p\s*=\s*" + P_NUMBER, r"p\s*<\s*" + P_NUMBER)
EFFECTS = (r"fold[- ]change[:\s=]+(\d+\.?\d*)", r"lda score[:\s=]+(\d+\.?\d*)", r"effect size[:\s=]+(\d+\.?\d*)", r"log2[- ]?fc[:\s=]+([+-]?\d+\.?\d*)")
# Statistical measures in order.
MEASURES: Table = (
    ("LDA score", (r"\blda score\b",)), ("fold change", (r"\bfold[- ]change\b",)), ("relative abundance", (r"\brelative abundance\b",)), ("log2 fold change", (r"\blog2[- ]?fc\b",)),
    ("odds ratio", (r"\bodds ratio\b",)), ("hazard ratio", (r"\bhazard ratio\b",)), ("correlation coefficient", (r"\bcorrelation coefficient\b",)),
)
COMPARED = r"\bvs\.?\b|\bversus\b|\bcompared (to|with)\b"
SIGNIFICANT = r"\bsignificant(ly)?\b|\bp\s*<\s*0\.05\b"
# Size of a sample in a methods text, in order.
SAMPLE_FORMS = (r"n\s*=\s*(\d+)", r"(\d+)\s+participants", r"(\d+)\s+subjects", r"(\d+)\s+patients")
DURATION = r"(\d+)\s*(week|month|day|year)s?"
DOSAGES = (r"(\d+(?:\^\d+)?\s*cfu)", r"(\d+\s*mg)", r"(\d+\s*g)\b")
PLATFORMS: Table = (("Illumina", (r"\billumina\b",)), ("PacBio", (r"\bpacbio\b",)), ("Oxford Nanopore", (r"\bnanopore\b",)), ("Ion Torrent", (r"\bion torrent\b",)))

# Kinds of interventions and the words that name them, the first of which that is found stands for the kind.
INTERVENTIONS: Table = (
    ("probiotic", ("probiotic", "lactobacillus", "bifidobacterium", "saccharomyces", "streptococcus thermophilus", "enterococcus faecium", "pediococcus", "leuconostoc", "live biotherapeutic", "biotherapeutic", "paraprobiotic", "psychobiotic", "postbiotic", "fermented milk", "yogurt", "kefir")),
    ("prebiotic", ("prebiotic", "inulin", "fructooligosaccharide", "fos", "galactooligosaccharide", "gos", "pectin", "psyllium", "betaglucan", "beta-glucan", "resistant starch", "dietary fiber", "fiber supplement")),
    ("synbiotic", ("synbiotic",)),
    ("postbiotic", ("postbiotic", "paraprobiotics", "heat-killed", "bacterial lysate", "cell-free supernatant")),
    ("FMT", ("fmt", "fecal microbiota transplant", "faecal microbiota transplant", "fecal transplant", "stool transplant", "microbiota transplant", "fecal bacteriotherapy", "bacteriotherapy", "capsule fmt", "enema fmt", "colonoscopic fmt")),
    ("fermented_food", ("fermented food", "fermented beverage", "fermented dairy", "sauerkraut", "kimchi", "kombucha", "miso", "tempeh", "natto", "kefir", "fermented soy")),
    ("antibiotic", ("antibiotic", "antibiotics", "antimicrobial", "amoxicillin", "metronidazole", "ciprofloxacin", "vancomycin", "rifaximin", "neomycin", "ampicillin", "tetracycline", "doxycycline", "clindamycin", "azithromycin", "clarithromycin", "fluoroquinolone", "cephalosporin", "penicillin", "carbapenems", "colistin", "polymyxin", "linezolid", "daptomycin", "fidaxomicin")),
    ("diet", ("diet", "dietary intervention", "caloric restriction", "calorie restriction", "intermittent fasting", "time-restricted eating", "time-restricted feeding", "fasting", "food supplementation", "nutritional intervention", "polyphenol", "quercetin", "resveratrol", "curcumin", "omega-3", "fish oil", "dha", "epa", "vitamin d", "vitamin b12", "vitamin k", "folate", "folic acid", "zinc", "iron", "magnesium", "calcium", "selenium")),
    ("metabolite_supplementation", ("butyrate", "propionate", "acetate", "short-chain fatty acid", "scfa", "bile acid", "secondary bile acid", "tryptophan", "indole", "serotonin", "gaba", "dopamine")),
    ("drug_metabolic", ("metformin", "insulin", "glp-1", "semaglutide", "liraglutide", "exenatide", "statin", "atorvastatin", "rosuvastatin", "levothyroxine", "thyroid hormone")),
    ("drug_gastro", ("proton pump inhibitor", "ppi", "omeprazole", "pantoprazole", "esomeprazole", "laxative", "antidiarrheal", "mesalazine", "sulfasalazine", "budesonide")),
    ("drug_immune", ("immunosuppressant", "corticosteroid", "prednisolone", "dexamethasone", "infliximab", "adalimumab", "vedolizumab", "ustekinumab", "tofacitinib", "nsaid", "non-steroidal anti-inflammatory", "ibuprofen", "aspirin", "naproxen")),
    ("drug_oncology", ("chemotherapy", "immunotherapy", "checkpoint inhibitor", "pd-1", "pd-l1", "pembrolizumab", "nivolumab", "ipilimumab")),
    ("drug_contraceptive", ("oral contraceptive", "hormone therapy", "hormonal contraception", "birth control pill")),
    ("exercise", ("exercise", "physical activity", "resistance training", "endurance training", "high-intensity interval training", "hiit", "yoga", "sedentary")),
    ("lifestyle_other", ("sleep", "stress", "mindfulness", "meditation", "smoking", "tobacco", "alcohol")),
    ("perinatal", ("breastfeeding", "breast milk", "human milk", "formula feeding", "infant formula", "cesarean section", "c-section", "caesarean", "vaginal delivery", "mode of delivery", "early-life antibiotic", "neonatal antibiotic")),
)

# Patterns of directions between two entities, in order, by vocabulary.
_ASSOCIATED, _CORRELATED, _LINKED = r"\bassociat(ed|ion)\b", r"\bcorrelat(ed|ion)\b", r"\blinked\s+to\b"
PRODUCE: Table = (
    ("produces", (r"\bproduc(es?|ed|tion)\b", r"\bgenerat(es?|ed|ion)\b", r"\bsynth(esizes?|esized|esis)\b", r"\bsecret(es?|ed|ion)\b", r"\bexcret(es?|ed|ion)\b", r"\breleas(es?|ed|ing)\b")),
    ("inhibits", (r"\binhibit(s|ed|ion|ing)\b", r"\bsuppress(es?|ed|ion)\b", r"\bblocks?\b", r"\breduces? (production|synthesis|secretion)\b")),
    ("associated", (_ASSOCIATED, _CORRELATED, _LINKED, r"\brelated\s+to\b")),
)
PATHWAY: Table = (
    ("activates", (r"\bactivat(es?|ed|ion|ing)\b", r"\binduces?\b", r"\bupregulat(es?|ed|ion)\b", r"\bpromot(es?|ed|ing)\b", r"\benhances?\b", r"\bstimulat(es?|ed|ion)\b", r"\btriggers?\b")),
    ("inhibits", (r"\binhibit(s|ed|ion|ing)\b", r"\bdownregulat(es?|ed|ion)\b", r"\bsuppress(es?|ed|ion)\b", r"\battenuates?\b", r"\bblocks?\b", r"\bimpairs?\b")),
    ("associated", (_ASSOCIATED, r"\bmodulat(es?|ed|ion)\b", r"\binfluences?\b", r"\baffects?\b")),
)
GENE: Table = (
    ("upregulates", (r"\bupregulat(es?|ed|ion)\b", r"\bincreased expression\b", r"\bhigher expression\b", r"\binduc(es?|ed|tion) of\b", r"\bactivat(es?|ed) (expression|transcription)\b")),
    ("downregulates", (r"\bdownregulat(es?|ed|ion)\b", r"\bdecreased expression\b", r"\blower expression\b", r"\brepresses?\b", r"\bsilenc(es?|ed|ing)\b")),
    ("associated", (_ASSOCIATED, r"\bregulat(es?|ed|ion)\b", r"\bexpression of\b", r"\baffects? expression\b")),
)
IMMUNE: Table = (
    ("activates", (r"\bactivat(es?|ed|ion|ing)\b", r"\bexpands?\b", r"\bpolariz(es?|ed|ation)\b", r"\bpromot(es?|ed) (differentiation|activation)\b", r"\bstimulat(es?|ed|ion)\b", r"\binduces?\b")),
    ("suppresses", (r"\bsuppress(es?|ed|ion)\b", r"\binhibit(s|ed)\b", r"\bimpairs?\b", r"\breduces? (activation|number|count)\b", r"\bregulat(es?|ed) negatively\b")),
    ("recruits", (r"\brecruit(s|ed|ment)\b", r"\battract(s|ed|ion)\b", r"\bmigrat(es?|ed|ion) of\b", r"\baccumulat(es?|ed|ion) of\b")),
    ("associated", (_ASSOCIATED, r"\binfluences?\b", r"\baffects?\b", _CORRELATED)),
)
CLINICAL: Table = (
    ("improves", (r"\bimproves?\b", r"\bameliorate(s|d)\b", r"\balleviate(s|d)\b", r"\breduces? (symptoms?|severity|score)\b", r"\bbetter\b", r"\bremission\b", r"\bhealing\b", r"\bresolution\b")),
    ("worsens", (r"\bworsens?\b", r"\bexacerbate(s|d)\b", r"\baggravate(s|d)\b", r"\bincreases? (symptoms?|severity|score|risk)\b", r"\brelapse\b", r"\bprogress(es?|ion)\b")),
    ("associated", (_ASSOCIATED, _CORRELATED, r"\bpredicts?\b", r"\bbiomarker\b", _LINKED)),
)
METABOLITE_DISEASE: Table = (
    ("increased", (r"\bincreased\b", r"\bhigher levels?\b", r"\belevated\b", r"\baccumulat(ed|ion)\b")),
    ("decreased", (r"\bdecreased\b", r"\blower levels?\b", r"\bdepleted\b", r"\bdeficien(t|cy)\b")),
    ("associated", (_ASSOCIATED, _LINKED, r"\bmarker\b", _CORRELATED)),
)
GENE_DISEASE: Table = (
    ("predisposes", (r"\bpredispos(es?|ed|ition)\b", r"\brisk factor\b", r"\bsusceptib(le|ility)\b", r"\bmutation\b", r"\bpolymorphism\b", r"\bvariant\b", r"\bincreases? risk\b")),
    ("protective", (r"\bprotect(s|ed|ive|ion)\b", r"\breduces? risk\b", r"\bprotective variant\b", r"\bresistance\b")),
    ("associated", (_ASSOCIATED, _LINKED, _CORRELATED, r"\bgwas\b")),
)
SHAPING: Table = (
    ("enriches", (r"\benrich(es?|ed|ment)\b", r"\bincreases? (abundance|count|level)\b", r"\bpromot(es?|ed) growth\b", r"\bfavor(s|ed)\b", r"\bexpand(s|ed)\b", r"\bprefer(s|red|ential)\b")),
    ("depletes", (r"\bdeplet(es?|ed|ion)\b", r"\breduces? (abundance|count|level)\b", r"\bsuppress(es?|ed) growth\b", r"\bdecreases? (abundance)\b", r"\beradicat(es?|ed)\b")),
    ("associated", (_ASSOCIATED, r"\bshapes?\b", r"\bmodulat(es?|ed)\b", r"\binfluences?\b", _CORRELATED)),
)
# The property that each pair type reads from the sentence, the first that is found.
METABOLITE_CLASS: Table = (("SCFA", (r"\bscfa\b", r"\bshort[- ]chain fatty acid\b")), ("bile acid", (r"\bbile acid\b",)), ("indole", (r"\bindole\b",)), ("LPS", (r"\blps\b", r"\blipopolysaccharide\b")))
PATHWAY_CATEGORY: Table = (("inflammatory", (r"\binflammator\b", r"\bnf.?kb\b", r"\btlr\b")), ("metabolic", (r"\bmetabol\b", r"\bbutyrate\b", r"\bscfa\b")), ("immune", (r"\bimmune\b", r"\bjak.?stat\b")))
MECHANISM: Table = (("epigenetic", (r"\bepigenetic\b", r"\bhistone\b", r"\bmethylation\b")), ("transcriptional", (r"\btranscription\b", r"\bpromoter\b")), ("post-translational", (r"\bpost.?translational\b", r"\bphosphorylation\b")))
IMMUNE_CONTEXT: Table = (("intestinal", (r"\bintestin\b", r"\bmucosal\b", r"\bgut\b")), ("systemic", (r"\bsystemic\b", r"\bperipheral blood\b", r"\bblood\b")))
OUTCOME_TYPE: Table = (("remission", (r"\bremission\b",)), ("relapse", (r"\brelapse\b", r"\brecurrence\b")), ("dysbiosis", (r"\bdysbiosis\b",)), ("permeability", (r"\bpermeab\b", r"\bleaky gut\b")))
METABOLITE_ROLE: Table = (("protective", (r"\bprotect(ive|s|ed)\b",)), ("pathogenic", (r"\bpathogen(ic|esis)?\b", r"\bdamag(es?|ing)\b")))
RESPONSE_CONTEXT: Table = (("intestinal", (r"\bintestin\b", r"\bmucosal\b", r"\bgut\b")), ("systemic", (r"\bsystemic\b", r"\bperipheral\b")))
VARIANT_TYPE: Table = (("SNP", (r"\bsnp\b", r"\bsingle nucleotide\b")), ("mutation", (r"\bmutation\b",)), ("polymorphism", (r"\bpolymorphism\b",)))
DIETARY_PATTERN: Table = (("Mediterranean", (r"\bmediterranean\b",)), ("high-fiber", (r"\bhigh.?fiber\b", r"\bdietary fiber\b")), ("ketogenic", (r"\bketogenic\b",)))
EXPOSURE_TYPE: Table = (("antibiotic", (r"\bantibiotic\b",)), ("birth_mode", (r"\bcesarean\b", r"\bc.?section\b", r"\bvaginal delivery\b")), ("breastfeeding", (r"\bbreastfeed\b", r"\bhuman milk\b")), ("geographic", (r"\bgeograph\b", r"\bcountry\b", r"\bregion\b")))

# Accession numbers and addresses of repositories, in order.
ACCESSIONS: Table = (
    ("SRA", (r"\bSRP\d{6,9}\b", r"\bSRR\d{6,9}\b", r"\bSRX\d{6,9}\b", r"\bSRS\d{6,9}\b")), ("NCBI BioProject", (r"\bPRJNA\d{6,9}\b", r"\bPRJEB\d{5,8}\b")), ("NCBI BioSample", (r"\bSAMN\d{8,11}\b", r"\bSAME\d{7,10}\b")),
    ("GEO", (r"\bGSE\d{4,8}\b", r"\bGSM\d{5,9}\b")), ("ENA", (r"\bERP\d{6,9}\b", r"\bERR\d{6,9}\b", r"\bERX\d{6,9}\b", r"\bERS\d{6,9}\b")), ("ArrayExpress", (r"\bE-MTAB-\d{3,6}\b", r"\bE-GEOD-\d{4,7}\b", r"\bE-TABM-\d{3,6}\b")),
    ("DDBJ", (r"\bDRP\d{6,9}\b", r"\bDRR\d{6,9}\b")), ("MGnify", (r"\bMGP\d{4,7}\b", r"\bMGYG[A-Z0-9]{8,12}\b")),
)
ADDRESSES: Table = (
    ("Zenodo", (r"https?://zenodo\.org/(?:record|deposit)/\d+",)), ("Figshare", (r"https?://(?:figshare\.com|doi\.org/10\.6084)/\S+",)), ("GitHub", (r"https?://github\.com/[\w\-]+/[\w\-]+(?:/[\w\-\.]+)*",)), ("OSF", (r"https?://osf\.io/[a-zA-Z0-9]{5,}",)),
    ("Dryad", (r"https?://datadryad\.org/\S+",)), ("Mendeley", (r"https?://data\.mendeley\.com/datasets/\S+",)), ("Harvard Dataverse", (r"https?://dataverse\.harvard\.edu/\S+",)), ("NCBI SRA", (r"https?://www\.ncbi\.nlm\.nih\.gov/(?:sra|bioproject|biosample)/\S+",)),
    ("GEO", (r"https?://www\.ncbi\.nlm\.nih\.gov/geo/query/acc\.cgi\?acc=\S+",)), ("ENA", (r"https?://(?:www\.)?ebi\.ac\.uk/ena/\S+",)),
)
NOT_APPLICABLE = (r"no (new )?data (were|was) (generated|created|collected)", r"all data (are|is) (contained|included) (within|in) (the|this)", r"data sharing not applicable", r"data sharing is not applicable", r"not applicable")
OPEN = (
    r"data (are|is) (publicly |freely )?(available|accessible)", r"publicly available", r"freely available", r"open access", r"deposited (at|in|to)", r"available (at|from|in|on)", r"can be (accessed|downloaded|found) (at|from)", r"uploaded to", r"submitted to",
)
RESTRICTED = (
    r"available (upon|on) (reasonable )?request", r"upon reasonable request", r"available from the (corresponding |)author", r"request to the author", r"may be made available", r"due to privacy", r"data cannot be shared", r"ethical restrictions",
    r"institutional data sharing agreement", r"data will be made available", r"available to (qualified |bona fide )?researchers", r"access can be requested", r"data access committee", r"controlled access",
)
EMAIL = r"[\w.-]+@[\w.-]+\.\w{2,}"

# Numbers that are no sample sizes, and sample sizes by tier, the first tier that is found.
SEARCH_COUNTS = (
    r"\b(?:identified|screened|retrieved|searched|found|yielded|abstracts?|titles?|records?|articles?|citations?|studies\s+identified|databases?|references?|included\s+studies|eligible\s+studies|selected\s+studies)\s+(?:\w+\s+){0,3}\d{2,6}\b",
    r"\b\d{2,6}\s+(?:records?|abstracts?|titles?|citations?|studies|trials|articles?\s+identified|references?)\b",
)
SAMPLE_TIERS = (
    (r"\bn\s*=\s*(\d{2,6})\b",),
    (r"\b(?:recruited|enrolled|randomized|randomised|assigned|registered|screened\s+and\s+enrolled)\s+(\d{2,6})\b",),
    (r"\b(\d{2,6})\s+(?:patients?|participants?|subjects?|volunteers?|individuals?|adults?|children|infants?|neonates?|women|men|cases?|controls?|donors?)\b",),
    (r"\b(?:a total of|total of|comprising|consisting of|including)\s+(\d{2,6})\s+(?:patients?|participants?|subjects?|volunteers?|individuals?|adults?)\b", r"\b(?:cohort|study population|sample)\s+of\s+(\d{2,6})\b"),
    (r"\b(\d{2,6})\s+(?:healthy|obese|overweight|diabetic|ibd|uc|cd|treatment[-\s]naive|antibiotic[-\s]naive|age[- ]matched|sex[- ]matched)\b",),
    (r"\b(\d{2,6})\s+(?:patienten|probanden|teilnehmer|personen|freiwilligen|sujets?|volontaires?|pacientes?|participantes?|sujetos?)\b", r"\b(\d{2,6})\s*例", r"\bau total\s+(\d{2,6})\b", r"\binsgesamt\s+(\d{2,6})\b"),
    (r"\b(?:stool|fecal|faecal|feces|faeces|biopsy|serum|blood)\s+samples?\s+(?:from|of)\s+(\d{2,6})\b", r"\b(\d{2,6})\s+(?:persons?|individuals?|people)\b"),
)
METHODS: Table = (
    ("16S rRNA sequencing", (r"\b16s\s*r?rna\b",)), ("shotgun metagenomics", (r"\bshotgun\s+metagenomic",)), ("whole metagenome seq", (r"\bwhole[\s-]metagenome\s+seq",)), ("metatranscriptomics", (r"\bmetatranscriptom",)),
    ("whole genome sequencing", (r"\bwhole[\s-]genome\s+seq", r"\bwgs\b")), ("amplicon sequencing", (r"\bamplicon\s+sequencing\b",)), ("metaproteomics", (r"\bmetaproteom",)), ("metabolomics", (r"\bmetabolomic",)), ("RNA-seq", (r"\brna[\s-]?seq\b",)),
    ("nanopore", (r"\bnanopore\b",)), ("PacBio", (r"\bpacbio\b", r"\bpacific\s+biosciences\b")), ("ITS sequencing", (r"\bits\s*[12]?\s+sequencing\b",)),
)
DATASETS = r"\b(?:PRJNA|PRJEB|PRJDB|SRP|SRR|SRX|SRS|ERR|ERX|ERS|ERP|DRP|DRR|GSE|GSM|E-MTAB-|E-GEOD-|SAMN|SAME|MGP)\d+\b"
SURE_DESIGN = r"\b(?:randomized\s+controlled|randomised\s+controlled|double[- ]blind|placebo[- ]controlled|prospective\s+(?:longitudinal\s+)?cohort)\b"
LIKELY_DESIGN = r"\b(?:cohort\s+study|cross[- ]sectional|case[- ]control|observational|retrospective\s+cohort|prospective\s+study)\b"
META = r"\bforest\s+plot\b|\bI[²2]\s*(?:heterogeneity|statistic)\b|\bpooled\s+(?:odds\s+ratio|risk\s+ratio|effect\s+size)\b|\brandom[- ]effects\s+model\b"

# Study designs with their confidence; the highest confidence counts, the first on ties.
DESIGNS = (
    ("rct", 0.95, r"\bdouble[- ]blind\b.{0,80}\bplacebo[- ]controlled\b|\bplacebo[- ]controlled\b.{0,80}\bdouble[- ]blind\b"),
    ("rct", 0.90, r"\brandomized\s+controlled\s+trial\b|\brandomised\s+controlled\s+trial\b|\bparallel[- ]group\s+(?:randomized|randomised)\b|\bcluster[- ]randomized\s+trial\b"),
    ("rct", 0.85, r"\bplacebo[- ]controlled\b.{0,50}\brandomized\b|\brandomized\b.{0,50}\bplacebo[- ]controlled\b|\bdouble[- ]blind\b.{0,50}\brandomized\b"),
    ("rct", 0.75, r"\bopen[- ]label\s+(?:randomized|randomised)\s+(?:controlled\s+)?trial\b|\bsingle[- ]blind\s+(?:randomized|randomised)\b"),
    ("meta_analysis", 0.95, r"\bmeta[- ]analysis\b.{0,100}\bsystematic\s+review\b|\bsystematic\s+review\b.{0,100}\bmeta[- ]analysis\b|\bpooled\s+(?:odds\s+ratio|risk\s+ratio|effect\s+size|estimate)\b|\bforest\s+plot\b|\brandom[- ]effects\s+model\b"),
    ("systematic_review", 0.90, r"\bsystematic(?:ally)?\s+(?:searched|reviewed|identified)\b|\bprisma\b|\binclusion\s+(?:and\s+exclusion\s+)?criteria\b.{0,200}\b(?:medline|pubmed|embase|cochrane|web\s+of\s+science)\b|\bstudies\s+were\s+(?:included|eligible|selected)\b"),
    ("cohort", 0.85, r"\bprospective\s+(?:longitudinal\s+)?cohort\b|\blongitudinal\s+(?:prospective\s+)?cohort\b|\bbirth\s+cohort\b|\bprospective\s+follow[- ]up\s+study\b"),
    ("cohort", 0.75, r"\bcohort\s+study\b|\bprospective\s+study\b|\blongitudinal\s+study\b|\bfollow[- ]up\s+(?:period|study|cohort)\b"),
    ("cohort", 0.65, r"\bretrospective\s+cohort\b|\bobservational\s+cohort\b"),
    ("case_control", 0.90, r"\bcase[- ]control\s+study\b|\bmatched\s+case[- ]control\b|\bcase[- ]control\s+design\b"),
    ("case_control", 0.75, r"\bcases\s+and\s+(?:matched\s+)?controls\b|\bcontrol\s+group\s+matched\b"),
    ("cross_sectional", 0.90, r"\bcross[- ]sectional\s+study\b|\bcross[- ]sectional\s+(?:survey|design|analysis)\b|\bprevalence\s+study\b"),
    ("cross_sectional", 0.70, r"\bsingle\s+(?:time\s+)?point\s+measurement\b|\bbaseline\s+only\b"),
    ("twin_study", 0.90, r"\btwin\s+(?:study|cohort|pairs?)\b|\bmonozygotic\s+twins?\b|\bdizygotic\s+twins?\b"),
    ("clinical_trial", 0.80, r"\bclinical\s+trial\b|\bintervention\s+study\b|\btreatment\s+arm\b|\bdose[- ]escalation\b"),
    ("observational", 0.70, r"\bobservational\s+study\b|\bepidemiological\s+study\b|\bpopulation[- ]based\s+study\b"),
    ("pilot", 0.60, r"\bpilot\s+(?:study|trial|rct|cohort)\b|\bfeasibility\s+(?:study|trial)\b|\bexploratory\s+(?:study|analysis)\b"),
    ("protocol", 0.85, r"\bstudy\s+protocol\b|\btrial\s+protocol\b|\bwill\s+be\s+(?:randomized|enrolled|recruited|assigned)\b|\bregistered\s+(?:at|with|in)\s+clinicaltrials\b"),
    ("case_report", 0.90, r"\bcase\s+report\b|\bcase\s+series\b|\bsingle\s+patient\b"),
    ("mendelian_randomization", 0.95, r"\bmendelian\s+randomiz"),
)
REGISTRATION = r"\bclinical\s+trial\s+registr"  # no trial of its own
IS_RCT, IS_PROSPECTIVE = r"\brandomized\b|\brandomised\b", r"\bprospective\b|\blongitudinal\b|\bfollow[- ]up\b"


# Article types by tag, by priority, by title (the first found) and by abstract (the surest found).
TAGS = (
    ("original_research", (
        "clinical trial", "clinical trial, phase i", "clinical trial, phase ii", "clinical trial, phase iii", "clinical trial, phase iv", "randomized controlled trial", "controlled clinical trial", "observational study",
        "comparative study", "multicenter study", "cohort study", "twin study", "validation study", "preprint", "research-article", "research article", "original article", "original research",
    )),
    ("narrative_review", ("review", "literature review", "review-article", "review article")), ("systematic_review", ("systematic review", "systematic-review")), ("meta_analysis", ("meta-analysis", "meta-analysis article")),
    ("case_report", ("case reports", "case-report")), ("letter", ("letter", "rapid-communication")), ("commentary", ("editorial", "comment", "news", "erratum")), ("protocol", ("clinical study protocol", "study characteristics")), ("dataset", ("dataset",)),
)
TYPES = ("meta_analysis", "systematic_review", "narrative_review", "protocol", "case_report", "dataset", "letter", "commentary", "original_research")
GENERIC_TAG = "journal article"
TITLES = (
    (r"\bmeta[- ]anal", "meta_analysis", 0.90), (r"\bpooled\s+anal", "meta_analysis", 0.85), (r"\bumbrella\s+review\b", "meta_analysis", 0.90), (r"\bsystematic\s+review\s+and\s+meta", "meta_analysis", 0.95), (r"\bsystematic\s+review\b", "systematic_review", 0.90), (r"\bscoping\s+review\b", "systematic_review", 0.85),
    (r"\brapid\s+(?:systematic\s+)?review\b", "systematic_review", 0.80), (r"\bnarrative\s+review\b", "narrative_review", 0.90), (r"\b(?:comprehensive|current)\s+review\b", "narrative_review", 0.80), (r"\bstudy\s+protocol\b", "protocol", 0.95),
    (r"\btrial\s+protocol\b", "protocol", 0.95), (r"\bprotocol\s+(?:for|of)\s+a\b", "protocol", 0.85), (r"\bcase\s+report\b", "case_report", 0.95), (r"\bcase\s+series\b", "case_report", 0.90), (r"\beditorial\b", "commentary", 0.90), (r"\bcommentary\b", "commentary", 0.90),
    (r"\bletter\s+to\s+the\s+editor\b", "letter", 0.95), (r"\bdata\s+descriptor\b", "dataset", 0.95), (r"\bpreprint\b", "original_research", 0.70), (r"\bcohort\s+study\b", "original_research", 0.80), (r"\brandomized\s+controlled\s+trial\b", "original_research", 0.85),
)
ABSTRACTS = (
    (r"\bforest\s+plot\b", "meta_analysis", 0.92), (r"\bI[²2]\s*(?:heterogeneity|statistic)", "meta_analysis", 0.92), (r"\bpooled\s+(?:odds\s+ratio|risk\s+ratio|effect\s+size|estimate)", "meta_analysis", 0.90), (r"\brandom[- ]effects\s+model\b", "meta_analysis", 0.88),
    (r"\bfixed[- ]effects\s+model\b", "meta_analysis", 0.85), (r"\bfunnel\s+plot\b", "meta_analysis", 0.85), (r"\bpublication\s+bias\b", "meta_analysis", 0.80), (r"\bwe\s+identified\s+\d+\s+(?:eligible\s+)?(?:studies|trials|articles)", "meta_analysis", 0.80),
    (r"\d+\s+(?:studies|trials|articles)\s+(?:were\s+)?(?:included|eligible)", "meta_analysis", 0.78), (r"\bprisma\b", "systematic_review", 0.88), (r"\b(?:medline|pubmed|embase|cochrane|web\s+of\s+science)\b.{0,60}\bsearch(?:ed)?\b", "systematic_review", 0.85),
    (r"\binclusion\s+(?:and\s+exclusion\s+)?criteria\b.{0,100}\b(?:studies|trials)\b", "systematic_review", 0.80), (r"\bstudies\s+were\s+(?:included|eligible|selected)\b", "systematic_review", 0.78), (r"\bsearch(?:ed)?\s+(?:the\s+)?(?:medline|pubmed|embase|cochrane)\b", "systematic_review", 0.82),
    (r"\bwe\s+(?:enrolled|recruited|randomized|randomised)\b", "original_research", 0.80), (r"\b(?:fecal|stool|biopsy|blood|saliva|urine)\s+samples?\b", "original_research", 0.72), (r"\bshotgun\s+metagenomic|16s\s+rrna\s+gene\s+sequen", "original_research", 0.78),
    (r"\bwe\s+collected\s+\d+|n\s*=\s*\d{2,}", "original_research", 0.70), (r"\bthis\s+protocol\s+describes\b", "protocol", 0.92), (r"\bwill\s+be\s+(?:randomly\s+)?assigned\b", "protocol", 0.85), (r"\bregistered\s+(?:at|with|on)\s+clinicaltrials\b", "protocol", 0.88), (r"\bprimary\s+outcome\s+will\s+be\b", "protocol", 0.80),
)
PARTS = ("background", "methods", "results", "conclusions", "objective", "findings", "purpose")
OVERRIDES = (
    (r"\bsystematic(?:ally)?\s+(?:search|review|identif)", "systematic_review", 0.80), (r"\bwe\s+searched\b.{0,80}\b(?:medline|pubmed|embase|cochrane|scopus|web\s+of\s+science)\b", "systematic_review", 0.82), (r"\bstudies?\s+(?:were\s+)?(?:included|eligible|selected|screened)\b", "systematic_review", 0.75),
    (r"\bnarrative\s+(?:review|synthesis|overview)\b", "narrative_review", 0.85), (r"\bwe\s+(?:review|summarize|summarise|overview|discuss)\b.{0,60}\b(?:literature|evidence|studies|data)\b", "narrative_review", 0.72), (r"\bexisting\s+(?:literature|evidence|studies|research)\b", "narrative_review", 0.65),
    (r"\bwill\s+be\s+(?:randomly\s+)?(?:assigned|allocated|enrolled|recruited)\b", "protocol", 0.85), (r"\bprimary\s+(?:end\s*point|outcome)\s+will\s+be\b", "protocol", 0.82), (r"\bstudy\s+(?:is\s+)?(?:registered|ongoing|planned|proposed)\b", "protocol", 0.78), (r"\bprotocol\s+(?:paper|article|report|for)\b", "protocol", 0.88),
)

# Predicates and their canonical forms, in order; words that vote for a category, in order; what is no predicate.
PREDICATES = (
    ("associated with", "ASSOCIATED_WITH"), ("is associated with", "ASSOCIATED_WITH"), ("correlates with", "CORRELATES_WITH"), ("correlates positively", "POSITIVELY_CORRELATES_WITH"), ("correlates negatively", "NEGATIVELY_CORRELATES_WITH"), ("linked to", "ASSOCIATED_WITH"), ("related to", "ASSOCIATED_WITH"),
    ("increases", "INCREASES"), ("increased", "INCREASES"), ("elevates", "INCREASES"), ("elevated", "INCREASES"), ("upregulates", "UPREGULATES"), ("upregulated", "UPREGULATES"), ("enriched in", "ENRICHED_IN"), ("overrepresented in", "ENRICHED_IN"), ("more abundant", "ENRICHED_IN"),
    ("decreases", "DECREASES"), ("decreased", "DECREASES"), ("reduces", "DECREASES"), ("reduced", "DECREASES"), ("depleted in", "DEPLETED_IN"), ("underrepresented in", "DEPLETED_IN"), ("less abundant", "DEPLETED_IN"), ("downregulates", "DOWNREGULATES"), ("downregulated", "DOWNREGULATES"),
    ("produces", "PRODUCES"), ("synthesizes", "PRODUCES"), ("generates", "PRODUCES"), ("inhibits", "INHIBITS"), ("suppresses", "INHIBITS"), ("activates", "ACTIVATES"), ("promotes", "PROMOTES"), ("enhances", "PROMOTES"), ("modulates", "MODULATES"), ("regulates", "REGULATES"), ("mediates", "MEDIATES"),
    ("influences", "INFLUENCES"), ("affects", "INFLUENCES"), ("degrades", "DEGRADES"), ("metabolizes", "METABOLIZES"), ("ferments", "FERMENTS"), ("colonizes", "COLONIZES"), ("improves", "IMPROVES"), ("worsens", "WORSENS"), ("treats", "TREATS"), ("prevents", "PREVENTS"), ("causes", "CAUSES"), ("predicts", "PREDICTS"),
    ("biomarker for", "BIOMARKER_FOR"), ("administered to", "ADMINISTERED_TO"), ("supplemented with", "SUPPLEMENTED_WITH"), ("treated with", "TREATED_WITH"), ("uses", "USES_METHODOLOGY"), ("sequenced with", "USES_METHODOLOGY"), ("analyzed by", "USES_METHODOLOGY"), ("measured by", "USES_METHODOLOGY"),
    ("reports_association", "REPORTS_ASSOCIATION"), ("reports_intervention_effect", "REPORTS_INTERVENTION_EFFECT"), ("uses_methodology", "USES_METHODOLOGY"),
)
CATEGORIES = (
    ("biosynthetic", "produce produces synthesize synthesizes generate generates ferment ferments metabolize metabolizes"),
    ("regulatory", "inhibit inhibits suppress suppresses activate activates promote promotes enhance enhances modulate modulates regulate regulates upregulate upregulates downregulate downregulates"),
    ("abundance", "enrich enriched deplete depleted abundant overrepresented underrepresented"), ("quantitative", "increase increases decrease decreases elevate elevates reduce reduces"), ("clinical", "improve improves worsen worsens treat treats prevent prevents cure cures"),
    ("causal", "cause causes induce induces trigger triggers"), ("associative", "associate associated correlate correlates link linked relate related"), ("mechanistic", "mediate mediates influence influences affect affects degrade degrades"),
    ("ecological", "colonize colonizes inhabit inhabits dominate dominates"), ("predictive", "predict predicts biomarker indicate indicates"), ("intervention", "administer administered supplement supplemented treated"), ("methodology", "use uses sequence sequenced analyze analyzed measure measured"),
)
NO_PREDICATES = "are is was were be been being have has had do does did the a an in on at to of and or"
RECORD_WORDS = ("author", "doi", "title", "journal", "published", "cited", "reference")
LONGEST_PREDICATE = 60
# Signs in names of journals.
PREDATORY = ("omics international", "longdom", "imedpub", "scitechnol", "gavin publishers", "hilaris", "herold journals", "peertechz", "scientific research publishing", "david publishing", "academic journals", "merit research", "wjpmr", "ejpmr", "ijpsr")
OPEN_JOURNALS = ("plos", "bmc", "frontiers", "elife", "open", "public library")


def joined(patterns: tuple[str, ...]) -> str:
    """One case-insensitive pattern that any of ``patterns`` matches."""
    return "(?is)" + "|".join(f"(?:{p})" for p in patterns)


def pairs(table: Table) -> tuple[tuple[str, str], ...]:
    return tuple((name, joined(p)) for name, p in table)
