"""Layer plans: silver (validate, join, enrich, aggregate), gold marts, serving."""
