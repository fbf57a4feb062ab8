"""An evidence-first analytics engine on Spark."""
