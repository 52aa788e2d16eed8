"""AES-256 in CBC mode with PKCS7 padding, for text columns."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the key derivation.
ITERATIONS = 11_000
KEY_BYTES = 32
SALT_BYTES = 16
IV_BYTES = 16


def derive_key(password: str, salt: bytes) -> bytes:
    """One 256-bit key per password and salt; derived once, never per row."""
    if not password:
        raise ValueError("the password must not be empty")
    if len(salt) != SALT_BYTES:
        raise ValueError(f"the salt must have {SALT_BYTES} bytes")
    return hashlib.pbkdf2_hmac("sha256", password.encode("utf-8"), salt, ITERATIONS, KEY_BYTES)


def encrypt(text: Column, key: bytes, iv: bytes | None = None) -> Column:
    """Ciphertext with a fresh initialisation vector per row in front of it; NULL stays NULL.

    With a given ``iv`` it is the bare ciphertext, as other tools store it beside the salt.
    """
    if iv is None:
        return F.aes_encrypt(text, F.lit(key), F.lit("CBC"), F.lit("PKCS"))
    sealed = F.aes_encrypt(text, F.lit(key), F.lit("CBC"), F.lit("PKCS"), F.lit(_checked(iv)))
    return F.substring(sealed, IV_BYTES + 1, 2_147_483_647)


def decrypt(cipher: Column, key: bytes, iv: bytes | None = None) -> Column:
    """The text of :func:`encrypt`; bare ciphertext needs its ``iv``."""
    sealed = cipher if iv is None else F.concat(F.lit(_checked(iv)), cipher)
    return F.aes_decrypt(sealed, F.lit(key), F.lit("CBC"), F.lit("PKCS")).cast("string")


def _checked(iv: bytes) -> bytes:
    if len(iv) != IV_BYTES:
        raise ValueError(f"the initialisation vector must have {IV_BYTES} bytes")
    return iv
