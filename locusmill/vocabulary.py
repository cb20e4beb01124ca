"""Word lists, lookup tables and formats that outputs must match."""

# Consequence terms, most severe first. The rank is the 0-based place.
CONSEQUENCE_TERMS = [
    "transcript_ablation",
    "splice_acceptor_variant",
    "splice_donor_variant",
    "stop_gained",
    "frameshift_variant",
    "stop_lost",
    "start_lost",
    "initiator_codon_variant",
    "transcript_amplification",
    "inframe_insertion",
    "inframe_deletion",
    "missense_variant",
    "protein_altering_variant",
    "splice_region_variant",
    "incomplete_terminal_codon_variant",
    "start_retained_variant",
    "stop_retained_variant",
    "synonymous_variant",
    "coding_sequence_variant",
    "mature_miRNA_variant",
    "5_prime_UTR_variant",
    "3_prime_UTR_variant",
    "non_coding_transcript_exon_variant",
    "non_coding_exon_variant",
    "intron_variant",
    "NMD_transcript_variant",
    "non_coding_transcript_variant",
    "nc_transcript_variant",
    "upstream_gene_variant",
    "downstream_gene_variant",
    "TFBS_ablation",
    "TFBS_amplification",
    "TF_binding_site_variant",
    "regulatory_region_ablation",
    "regulatory_region_amplification",
    "feature_elongation",
    "regulatory_region_variant",
    "feature_truncation",
    "intergenic_variant",
]

# Terms left out of transcript annotations by default.
OMITTED_TERMS = ["upstream_gene_variant", "downstream_gene_variant"]

# The last term of each category, by severity.
LOF_UP_TO = "frameshift_variant"
MISSENSE_UP_TO = "missense_variant"
SYNONYMOUS_UP_TO = "synonymous_variant"

# Splice terms whose display name comes from the coding-DNA string.
SPLICE_TERMS = ["splice_donor_variant", "splice_acceptor_variant", "splice_region_variant"]

# Amino-acid letters.
AMINO_ACIDS = {
    "A": "Ala", "C": "Cys", "D": "Asp", "E": "Glu", "F": "Phe", "G": "Gly",
    "H": "His", "I": "Ile", "K": "Lys", "L": "Leu", "M": "Met", "N": "Asn",
    "P": "Pro", "Q": "Gln", "R": "Arg", "S": "Ser", "T": "Thr", "V": "Val",
    "W": "Trp", "Y": "Tyr", "X": "Ter", "*": "Ter", "U": "Sec",
}

# Gold stars by review status.
GOLD_STARS = {
    "no_interpretation_for_the_single_variant": 0,
    "no_assertion_provided": 0,
    "no_assertion_criteria_provided": 0,
    "criteria_provided,_single_submitter": 1,
    "criteria_provided,_conflicting_interpretations": 1,
    "criteria_provided,_multiple_submitters,_no_conflicts": 2,
    "reviewed_by_expert_panel": 3,
    "practice_guideline": 4,
}

# Cohort labels.
QUALITY_GROUPS = ["adj", "raw"]
POPULATIONS = ["afr", "amr", "eas", "eur", "oth", "sas"]
PROBAND_LABEL = "proband"
SEX_LABELS = {"M": "male", "F": "female"}
LABEL_ORDER = ["popmax", "group", "pop", "proband", "subpop", "sex"]

# Sub-populations and frequency bundles of a flattened release table.
RELEASE_SUBPOPULATIONS = {
    "afr": ["female", "male"],
    "amr": ["female", "male"],
    "asj": ["female", "male"],
    "eas": ["female", "male", "jpn", "kor", "oea"],
    "fin": ["female", "male"],
    "nfe": ["female", "male", "bgr", "est", "nwe", "onf", "seu", "swe"],
    "oth": ["female", "male"],
    "sas": ["female", "male"],
}
FILTERING_AF_POPULATIONS = ["afr", "amr", "eas", "nfe", "sas"]
FREQUENCY_FIELDS = ["AC_adj", "AF_adj", "AN_adj", "nhomalt_adj"]
FILTERING_AF_FIELDS = ["faf95_adj", "faf99_adj"]
POPMAX_FIELDS = [
    "AC_popmax", "AC_raw", "AF_popmax", "AF_raw", "AN_popmax", "AN_raw",
    "nhomalt_popmax", "nhomalt_raw", "popmax",
]

# Field lists of the dormant release and constraint projections.
RELEASE_HISTOGRAMS = [
    "ab_hist_alt", "dp_hist_all", "dp_hist_alt", "gq_hist_all", "gq_hist_alt",
    "gnomad_age_hist_het", "gnomad_age_hist_hom",
]
SITE_QUALITY_FIELDS = [
    "BaseQRankSum", "ClippingRankSum", "DP", "FS", "InbreedingCoeff", "MQ",
    "MQRankSum", "QD", "ReadPosRankSum", "SOR", "VQSLOD", "VQSR_culprit",
    "VQSR_NEGATIVE_TRAIN_SITE", "VQSR_POSITIVE_TRAIN_SITE",
]
INFO_QUALITY_FIELDS = {
    "MQ": "MQ",
    "MQRankSum": "MQRankSum",
    "QD": "QD",
    "ReadPosRankSum": "ReadPosRankSum",
    "SOR": "SOR",
    "POSITIVE_TRAIN_SITE": "VQSR_POSITIVE_TRAIN_SITE",
    "NEGATIVE_TRAIN_SITE": "VQSR_NEGATIVE_TRAIN_SITE",
}
CONSTRAINT_FIELDS = [
    "exp_lof", "exp_mis", "exp_syn", "obs_lof", "obs_mis", "obs_syn",
    "oe_lof", "oe_lof_lower", "oe_mis", "oe_mis_lower", "oe_mis_upper",
    "oe_syn", "oe_syn_lower", "oe_syn_upper", "lof_z", "mis_z", "syn_z",
    "pLI", "pNull", "pRec",
]

# Contig lengths of the two supported genome builds.
CONTIG_LENGTHS_37 = {
    "1": 249250621, "2": 243199373, "3": 198022430, "4": 191154276,
    "5": 180915260, "6": 171115067, "7": 159138663, "8": 146364022,
    "9": 141213431, "10": 135534747, "11": 135006516, "12": 133851895,
    "13": 115169878, "14": 107349540, "15": 102531392, "16": 90354753,
    "17": 81195210, "18": 78077248, "19": 59128983, "20": 63025520,
    "21": 48129895, "22": 51304566, "X": 155270560, "Y": 59373566, "MT": 16569,
}
CONTIG_LENGTHS_38 = {
    "chr1": 248956422, "chr2": 242193529, "chr3": 198295559, "chr4": 190214555,
    "chr5": 181538259, "chr6": 170805979, "chr7": 159345973, "chr8": 145138636,
    "chr9": 138394717, "chr10": 133797422, "chr11": 135086622, "chr12": 133275309,
    "chr13": 114364328, "chr14": 107043718, "chr15": 101991189, "chr16": 90338345,
    "chr17": 83257441, "chr18": 80373285, "chr19": 58617616, "chr20": 64444167,
    "chr21": 46709983, "chr22": 50818468, "chrX": 156040895, "chrY": 57227415,
    "chrM": 16569,
}
CONTIG_LENGTHS = {"37": CONTIG_LENGTHS_37, "38": CONTIG_LENGTHS_38}

# Characters a document field name cannot hold, and their escapes.
NAME_ESCAPE = "$"
NAME_BAD_LEADING = ["_", "-", "+", "$"]
NAME_ESCAPES = {
    ".": "_$dot$_",
    ",": "_$comma$_",
    "#": "_$hash$_",
    "*": "_$star$_",
    "(": "_$lp$_",
    ")": "_$rp$_",
    "[": "_$lsb$_",
    "]": "_$rsb$_",
    "{": "_$lcb$_",
    "}": "_$rcb$_",
}

# The document write modes.
WRITE_MODES = ["index", "create", "update", "upsert"]

# Column names of expression tissues.
TISSUE_COLUMNS = {
    "Adipose - Subcutaneous": "adiposeSubcutaneous",
    "Adipose - Visceral (Omentum)": "adiposeVisceralOmentum",
    "Adrenal Gland": "adrenalGland",
    "Artery - Aorta": "arteryAorta",
    "Artery - Coronary": "arteryCoronary",
    "Artery - Tibial": "arteryTibial",
    "Bladder": "bladder",
    "Brain - Amygdala": "brainAmygdala",
    "Brain - Anterior cingulate cortex (BA24)": "brainAnteriorcingulatecortexBa24",
    "Brain - Caudate (basal ganglia)": "brainCaudateBasalganglia",
    "Brain - Cerebellar Hemisphere": "brainCerebellarhemisphere",
    "Brain - Cerebellum": "brainCerebellum",
    "Brain - Cortex": "brainCortex",
    "Brain - Frontal Cortex (BA9)": "brainFrontalcortexBa9",
    "Brain - Hippocampus": "brainHippocampus",
    "Brain - Hypothalamus": "brainHypothalamus",
    "Brain - Nucleus accumbens (basal ganglia)": "brainNucleusaccumbensBasalganglia",
    "Brain - Putamen (basal ganglia)": "brainPutamenBasalganglia",
    "Brain - Spinal cord (cervical c-1)": "brainSpinalcordCervicalc1",
    "Brain - Substantia nigra": "brainSubstantianigra",
    "Breast - Mammary Tissue": "breastMammarytissue",
    "Cells - EBV-transformed lymphocytes": "cellsEbvTransformedlymphocytes",
    "Cells - Transformed fibroblasts": "cellsTransformedfibroblasts",
    "Cervix - Ectocervix": "cervixEctocervix",
    "Cervix - Endocervix": "cervixEndocervix",
    "Colon - Sigmoid": "colonSigmoid",
    "Colon - Transverse": "colonTransverse",
    "Esophagus - Gastroesophageal Junction": "esophagusGastroesophagealjunction",
    "Esophagus - Mucosa": "esophagusMucosa",
    "Esophagus - Muscularis": "esophagusMuscularis",
    "Fallopian Tube": "fallopianTube",
    "Heart - Atrial Appendage": "heartAtrialappendage",
    "Heart - Left Ventricle": "heartLeftventricle",
    "Kidney - Cortex": "kidneyCortex",
    "Liver": "liver",
    "Lung": "lung",
    "Minor Salivary Gland": "minorSalivaryGland",
    "Muscle - Skeletal": "muscleSkeletal",
    "Nerve - Tibial": "nerveTibial",
    "Ovary": "ovary",
    "Pancreas": "pancreas",
    "Pituitary": "pituitary",
    "Prostate": "prostate",
    "Skin - Not Sun Exposed (Suprapubic)": "skinNotsunexposedSuprapubic",
    "Skin - Sun Exposed (Lower leg)": "skinSunexposedLowerleg",
    "Small Intestine - Terminal Ileum": "smallIntestineTerminalileum",
    "Spleen": "spleen",
    "Stomach": "stomach",
    "Testis": "testis",
    "Thyroid": "thyroid",
    "Uterus": "uterus",
    "Vagina": "vagina",
    "Whole Blood": "wholeBlood",
}
