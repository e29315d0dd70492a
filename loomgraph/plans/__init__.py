"""Query languages and services, compiled to DataFrame plans."""
