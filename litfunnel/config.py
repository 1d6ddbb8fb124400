"""Fixed values of the scoring rules. Each is a default that the operators take as a parameter."""

from __future__ import annotations

#: Weights of the quality rubric, and the evidence factor's offset and slope.
QUALITY_WEIGHTS = {"technical_significance": 0.28, "apparent_novelty": 0.24, "practical_applicability": 0.20, "potential_value": 0.16, "longevity": 0.12}
EVIDENCE_FACTOR = (0.70, 0.03)
GATE, PERCENTILE, RELEVANCE_FLOOR, DISAGREEMENT = 5.0, 15, 5.0, 3.0
ORG_BOOST_CAP, PERSON_BOOST_CAP, CONFIDENCE_FLOOR = 0.5, 0.3, 0.6

#: Standing of an organisation by watch-list priority; any other watch-listed one; an unlisted one.
STANDING = {3: 10.0, 2: 8.0, 1: 6.0}
STANDING_LISTED, STANDING_UNLISTED = 6.0, 3.0
#: Weight of evidence by its type, current and earlier names; of any other type.
EVIDENCE_WEIGHTS = {
    "explicit_paper_affiliation": 1.0,
    "email_domain": 1.0,
    "ror_canonical_match": 0.9,
    "openalex_paper_specific": 0.9,
    "author_profile_secondary": 0.5,
    "paper_affiliation": 1.0,
    "ror_match": 0.9,
    "alias_match": 0.9,
    "openalex_authorship": 0.9,
    "author_profile": 0.5,
}
EVIDENCE_WEIGHT_OTHER = 0.5

#: USD for a million input and output tokens.
PRICES = {"z-ai/glm-5.3-flash": (0.15, 0.50), "openai/gpt-5.6-sol": (1.25, 10.00)}

TRACKING_PARAMS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "gclid", "fbclid", "mc_cid", "mc_eid")

#: Topic patterns, searched without regard to case.
TOPICS = {
    "AI agents": [r"\bagent(ic|s)?\b", r"\bmulti[- ]agent\b", r"\btool use\b", r"\bcomputer use\b"],
    "LLMs / foundation models": [r"\bllm(s)?\b", r"\blarge language model", r"\bfoundation model", r"\btransformer(s)?\b"],
    "Machine learning": [r"\bmachine learning\b", r"\bdeep learning\b", r"\bneural network"],
    "Data science": [r"\bdata science\b", r"\bstatistical learning\b"],
    "Multimodal AI": [r"\bmultimodal\b", r"\bvision[- ]language\b", r"\bvlm(s)?\b"],
    "AI engineering / ML systems": [r"\bmlops\b", r"\bllmops\b", r"\binference serving\b", r"\bmodel serving\b", r"\bai engineering\b"],
    "AI evaluation": [r"\beval(s|uation)?\b", r"\bbenchmark(s|ing)?\b", r"\bgrader(s)?\b"],
    "AI safety and security": [r"\balignment\b", r"\bai safety\b", r"\bmodel safety\b", r"\bjailbreak", r"\bprompt injection\b", r"\bai security\b"],
    "Retrieval / RAG": [r"\brag\b", r"\bretrieval[- ]augmented\b", r"\bvector search\b", r"\bretrieval\b"],
    "Model training, inference and efficiency": [r"\btraining\b", r"\binference\b", r"\bquantization\b", r"\bdistillation\b", r"\bmixture of experts\b", r"\bmoe\b"],
    "Applied AI": [r"\bapplied ai\b", r"\bai application", r"\bgenerative ai\b"],
    "Human-AI interaction": [r"\bhuman[- ]ai\b", r"\bhuman computer interaction\b", r"\bhci\b"],
    "AI product and experimentation": [r"\ba/b test", r"\bexperimentation\b", r"\bai product\b", r"\bproduct management\b"],
}
AI_CATEGORIES = ("cs.AI", "cs.CL", "cs.CV", "cs.LG", "cs.MA", "cs.RO", "stat.ML")
RESEARCH_SOURCES = ("arxiv", "research_paper", "company_research")
#: Categories that are ingested; one without a dot stands for its whole archive.
INGESTED_CATEGORIES = ("cs", "cs.AI", "cs.CL", "cs.CV", "cs.LG", "cs.NE", "stat.ML")

SCREEN_DIMENSIONS = ("ai_relevance", "technical_significance", "apparent_novelty", "evidence_strength")
RUBRIC_DIMENSIONS = (*QUALITY_WEIGHTS, "evidence_strength")

#: The closed vocabularies of the classification.
AUDIENCES = ("practitioner", "technical_leadership", "enterprise_adoption", "student")
SUBDOMAINS = {
    "computer_vision": ["object_detection", "image_segmentation", "image_generation", "video_understanding", "3d_vision"],
    "natural_language_processing": ["language_modeling", "information_extraction", "summarization", "machine_translation", "question_answering", "retrieval"],
    "speech_audio": ["speech_recognition", "speech_synthesis", "audio_understanding"],
    "reinforcement_learning": ["offline_rl", "multi_agent_rl", "rlhf"],
    "graph_learning": ["graph_neural_networks", "knowledge_graphs"],
    "generative_models": ["diffusion", "gans", "autoregressive_generation"],
    "multimodal_learning": ["vision_language", "audio_visual"],
    "model_compression": ["quantization", "pruning", "distillation"],
    "efficient_inference": ["serving", "caching", "speculative_decoding"],
    "interpretability": ["attribution", "mechanistic_interpretability"],
    "alignment_safety": ["jailbreak_robustness", "preference_alignment", "content_safety"],
    "evaluation_benchmarking": ["benchmark_design", "eval_methodology"],
    "robotics_embodied": ["manipulation", "navigation", "world_models"],
    "systems_infrastructure": ["training_systems", "distributed_training", "data_pipelines"],
    "theory_foundations": ["optimization", "generalization", "representation_learning"],
}
APPLICATIONS = (
    "healthcare_life_sciences", "financial_services", "mining_resources", "manufacturing", "energy_utilities", "agriculture_food",
    "legal_compliance", "education", "cybersecurity", "drug_discovery", "autonomous_systems", "hardware_design", "content_moderation",
    "enterprise_workforce", "scientific_research", "transport_logistics", "general_method",
)
#: Excludes every other application.
GENERAL_METHOD = "general_method"
