"""Part of weftline; see the README for what is where."""
