"""talkloom: chat and dictation datasets, and blind A/B evaluation, on Spark."""
