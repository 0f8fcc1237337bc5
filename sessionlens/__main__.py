"""``python -m sessionlens ...`` runs the model command line (``sessionlens.cli``)."""

from sessionlens.cli import main

main()
