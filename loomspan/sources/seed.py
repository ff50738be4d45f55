"""The seed list of known companies and its lookup table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions.names import seed_key

# Canonical name, domain, and all known further spellings.
SEED = [
    ("OpenAI", "openai.com", ["OpenAI, Inc.", "Open AI", "OpenAI LLC", "OpenAI Global LLC", "openai.com"]),
    ("Anthropic", "anthropic.com", ["Anthropic PBC", "Anthropic, Inc.", "Anthropic AI", "anthropic.com"]),
    ("Cohere", "cohere.com", ["Cohere Inc.", "Cohere AI", "cohere.com"]),
    ("Mistral AI", "mistral.ai", ["Mistral", "Mistral AI SAS", "Mistral.ai", "mistral.ai"]),
    ("Scale AI", "scale.com", ["Scale", "Scale AI, Inc.", "Scale, Inc.", "scale.com"]),
    ("Hugging Face", "huggingface.co", ["HuggingFace", "Hugging Face, Inc.", "HuggingFace Inc", "huggingface.co"]),
    ("Perplexity AI", "perplexity.ai", ["Perplexity", "Perplexity, Inc.", "Perplexity AI, Inc.", "perplexity.ai"]),
    ("Midjourney", "midjourney.com", ["Midjourney, Inc.", "Midjourney Inc", "midjourney.com"]),
    ("Runway", "runwayml.com", ["RunwayML", "Runway AI, Inc.", "Runway AI", "runwayml.com"]),
    ("ElevenLabs", "elevenlabs.io", ["Eleven Labs", "ElevenLabs, Inc.", "ElevenLabs Inc", "elevenlabs.io"]),
    ("Character.ai", "character.ai", ["Character AI", "Character Technologies, Inc.", "c.ai", "character.ai"]),
    ("Glean", "glean.com", ["Glean Technologies, Inc.", "Glean Work AI", "glean.com"]),
    ("Pinecone", "pinecone.io", ["Pinecone Systems, Inc.", "Pinecone Vector Database", "pinecone.io"]),
    ("Weaviate", "weaviate.io", ["Weaviate B.V.", "Weaviate Cloud", "weaviate.io"]),
    ("LangChain", "langchain.com", ["LangChain, Inc.", "LangChain Inc", "LangChain AI", "langchain.com"]),
    ("LlamaIndex", "llamaindex.ai", ["Llama Index", "LlamaIndex, Inc.", "llamaindex.ai"]),
    ("Together AI", "together.ai", ["Together Computer, Inc.", "Together", "together.ai"]),
    ("Groq", "groq.com", ["Groq, Inc.", "Groq Inc", "groq.com"]),
    ("Cerebras Systems", "cerebras.net", ["Cerebras", "Cerebras Systems, Inc.", "cerebras.net"]),
    ("Harvey", "harvey.ai", ["Harvey AI", "Counsel AI Corp.", "harvey.ai"]),
    ("Cursor", "cursor.com", ["Anysphere, Inc.", "Anysphere", "Cursor AI", "cursor.com", "cursor.sh"]),
    ("LiveKit", "livekit.io", ["LiveKit, Inc.", "LiveKit Inc", "livekit.io"]),
    ("DeepL", "deepl.com", ["DeepL SE", "DeepL GmbH", "deepl.com"]),
    ("Synthesia", "synthesia.io", ["Synthesia Ltd.", "Synthesia Limited", "synthesia.io"]),
    ("HeyGen", "heygen.com", ["HeyGen, Inc.", "Movio", "heygen.com"]),
    ("Pika", "pika.art", ["Pika Labs, Inc.", "Pika Labs", "pika.art"]),
    ("Suno", "suno.ai", ["Suno AI", "Suno, Inc.", "suno.ai", "suno.com"]),
    ("Udio", "udio.com", ["Uncharted Labs, Inc.", "Udio AI", "udio.com"]),
    ("Abridge", "abridge.com", ["Abridge AI, Inc.", "abridge.com"]),
    ("Covariant", "covariant.ai", ["Covariant.ai", "Covariant AI", "covariant.ai"]),
    ("Figure AI", "figure.ai", ["Figure", "Figure Technologies AI", "figure.ai"]),
    ("Shield AI", "shield.ai", ["Shield AI, Inc.", "shield.ai"]),
    ("Adept AI", "adept.ai", ["Adept", "Adept AI Labs, Inc.", "adept.ai"]),
    ("Inflection AI", "inflection.ai", ["Inflection", "Inflection AI, Inc.", "Pi AI", "inflection.ai"]),
    ("Stability AI", "stability.ai", ["Stability AI Ltd.", "Stability AI, Inc.", "stability.ai"]),
    ("Replit", "replit.com", ["Replit, Inc.", "Repl.it", "replit.com"]),
    ("Weights & Biases", "wandb.ai", ["W&B", "Wandb", "Weights and Biases, Inc.", "wandb.ai"]),
    ("Anyscale", "anyscale.com", ["Anyscale, Inc.", "Ray AI", "anyscale.com"]),
    ("Modal", "modal.com", ["Modal Labs, Inc.", "Modal Labs", "modal.com"]),
    ("Baseten", "baseten.co", ["Baseten, Inc.", "baseten.co"]),
    ("Lamini", "lamini.ai", ["Lamini AI", "Lamini, Inc.", "lamini.ai"]),
    ("Writer", "writer.com", ["Writer, Inc.", "Writer AI", "writer.com"]),
    ("Jasper", "jasper.ai", ["Jasper AI", "Jasper AI, Inc.", "Jarvis.ai", "jasper.ai"]),
    ("Copy.ai", "copy.ai", ["Copy AI", "CopyAI, Inc.", "copy.ai"]),
    ("Descript", "descript.com", ["Descript, Inc.", "descript.com"]),
    ("Otter.ai", "otter.ai", ["Otter AI", "AISense, Inc.", "otter.ai"]),
    ("Notion", "notion.so", ["Notion Labs, Inc.", "Notion AI", "notion.so", "notion.com"]),
    ("CodiumAI", "qodo.ai", ["Qodo", "Codium", "Codium AI, Inc.", "codium.ai"]),
    ("Tabnine", "tabnine.com", ["Codota Dot Com Ltd.", "TabNine", "tabnine.com"]),
    ("Poolside", "poolside.ai", ["Poolside AI", "Poolside, Inc.", "poolside.ai"]),
]


def seed_lookup(spark: SparkSession) -> DataFrame:
    """(seed_key, canonical), one row for each key; of entries that share a key the later one holds."""
    rows = [(i, name, form) for i, (name, domain, more) in enumerate(SEED) for form in (name, domain, *more)]
    text = json.dumps([{"i": i, "canonical": name, "form": form} for i, name, form in rows])
    table = spark.range(1).select(F.inline(F.from_json(F.lit(text), "array<struct<i:int,canonical:string,form:string>>")))
    keyed = table.select("i", "canonical", seed_key(F.col("form")).alias("seed_key")).where("seed_key != ''")
    return keyed.groupBy("seed_key").agg(F.max_by("canonical", "i").alias("canonical"))
