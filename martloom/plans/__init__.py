"""The four composed loads: company dimension, direct-mail and e-mail facts, taxonomy."""
